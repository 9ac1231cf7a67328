from revenue_lens.streaming.customer_state import CustomerState, customer_state_stream
from revenue_lens.streaming.jobs import drift_alert_writer, score_request_stream, weekly_revenue_stream

__all__ = ["CustomerState", "customer_state_stream", "drift_alert_writer", "score_request_stream", "weekly_revenue_stream"]
