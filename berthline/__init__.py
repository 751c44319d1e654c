"""berthline: container-terminal analytics on Spark.

Bronze (raw Kafka-shaped rows) -> silver (parsed, flattened events) -> gold
(container flows, crane performance, anomalies, daily KPIs, gate traffic),
expressed as DataFrame functions that serve batch and Structured Streaming
alike.
"""

__version__ = "0.1.0"
