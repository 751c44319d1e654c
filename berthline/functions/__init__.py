from .rules import (  # noqa: F401
    anomaly_severity, container_status, dwell_category, dwell_hours, epoch_to_iso,
    ocr_band, peak_category, performance_rating, process_type_desc, transport_mode_desc,
)
