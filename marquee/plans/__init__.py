from marquee.plans.answers import analytics_frames, run_analytics
from marquee.plans.curation import curate, curated_frames, curation_report, stage_extracts
from marquee.plans.smoke import ping
from marquee.plans.whole_run import run

__all__ = [
    "analytics_frames",
    "curate",
    "curated_frames",
    "curation_report",
    "ping",
    "run",
    "run_analytics",
    "stage_extracts",
]
