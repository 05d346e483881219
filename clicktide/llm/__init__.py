"""Operations of a training-data pipeline over tables of texts.

Nothing outside this folder imports it. Each module holds one operator; ``queries``
applies them to the test tables.
"""
