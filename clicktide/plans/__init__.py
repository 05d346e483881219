from clicktide.plans.daily import (
    DailyRun,
    ReportBundle,
    ReportPaths,
    build_report_bundle,
    product_activity,
    run_daily_reports,
    write_archive_reports,
    write_report_bundle,
)

__all__ = [
    "DailyRun", "ReportBundle", "ReportPaths", "build_report_bundle",
    "product_activity", "run_daily_reports", "write_archive_reports", "write_report_bundle",
]
