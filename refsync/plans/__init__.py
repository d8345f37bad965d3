from refsync.plans.export import export_changes, export_full
from refsync.plans.facility_import import ReferenceTables, report_recipients, run_import

__all__ = ["export_changes", "export_full", "ReferenceTables", "report_recipients", "run_import"]
