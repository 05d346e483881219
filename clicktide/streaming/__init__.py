from clicktide.streaming.pipeline import (
    PipelineConfig,
    detect_alerts,
    run_pipeline,
    start_pipeline,
)

__all__ = ["PipelineConfig", "detect_alerts", "run_pipeline", "start_pipeline"]
