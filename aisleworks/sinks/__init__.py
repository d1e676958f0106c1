from aisleworks.sinks.export import audit_frame, export_snapshot, snapshot
from aisleworks.sinks.partitioned import write_partition

__all__ = ["audit_frame", "export_snapshot", "snapshot", "write_partition"]
