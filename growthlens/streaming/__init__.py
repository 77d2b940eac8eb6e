from growthlens.streaming.events import (
    clean_event_stream,
    start_cohorts,
    start_event_cleaning,
    start_funnel_counts,
)

__all__ = ["clean_event_stream", "start_cohorts", "start_event_cleaning", "start_funnel_counts"]
