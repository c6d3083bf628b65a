"""Sources and sinks: table scans, CSV lookups, landed JSON feed pages, report writer."""

from planpulse.sources.feed import chain_problems, load_feed  # noqa: F401
from planpulse.sources.lookups import (  # noqa: F401
    load_alias_map, load_assessments, read_assessments, load_staff_map, load_targets,
)
from planpulse.sources.registry import ResultRegistry  # noqa: F401
from planpulse.sources.sinks import expire_versions, publish_report, read_report, write_report  # noqa: F401
from planpulse.sources.tables import load_tables  # noqa: F401
