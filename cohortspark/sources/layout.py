"""Names a site gives its source tables, id columns and id types."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import SRC_ORD


@dataclass(frozen=True)
class Layout:
    """Defaults are neutral; set each to what the source really uses."""

    subjects: str = "subject_info"
    screened: str = "phone_screen"
    visits: str = "visit_log"
    visit_studies: str = "visit_study_flags"
    disorders: str = "disorders"
    scan_ids: str = "scan_ids"
    tasks: str = "tasks"
    task_table_regex: str = "^d[A-Z]"
    person_id: str = "PersonID"
    screen_id: str = "ScreenID"
    visit_id: str = "VisitID"
    scan_id: str = "ScanID"
    primary_type: str = "PrimaryID"
    scan_type: str = "ScanID"
    bad_visits: tuple = ()

    def task_tables(self, sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """The source tables whose name marks them as a task."""
        return {n: sources[n] for n in sources if re.search(self.task_table_regex, n)}


def source_order(df: DataFrame, *fallback: str) -> list[Column]:
    """Input order of a source: ``_src_ord`` where the scan kept it, else the given key."""
    return [F.col(SRC_ORD)] if SRC_ORD in df.columns else [F.col(c) for c in fallback]
