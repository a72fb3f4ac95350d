"""The SQL table functions, asked in SQL and checked like the DataFrame functions they stand for."""

from __future__ import annotations

from touchgrid.catalog import outcomes, reports
from touchgrid.catalog.registry import all_oracles, query
from touchgrid.plans import table_functions


def asked(t, name: str, start: str, end: str, flags: bool = False):
    """Rows of a table function over the tables of `t`."""
    found = outcomes.flags(t) if flags else None
    prefix = "touchgrid_"
    table_functions.register(t.spark, t["activity"], t["activity_flat"], t["dim_ca"], t["dim_account"], found, prefix)
    return t.spark.sql(f"SELECT * FROM {prefix}{name}(DATE '{start}', DATE '{end}')")


def _face(name: str, covers: str, like: str, start: str, end: str, flags: bool = False) -> None:
    # The check of the DataFrame form, whose views are written out in it.
    @query(f"sql_{name}", covers, all_oracles()[like])
    def _(t):
        return asked(t, name, start, end, flags)


for _name, _covers in (
    ("rep_scorecard", "F1"), ("rep_account_drilldown", "F8"), ("account_contact_drilldown", "F9"), ("owned_account_coverage", "F10"),
):
    _face(_name, _covers, "rep_scorecard_window" if _name == "rep_scorecard" else _name, reports.START, reports.END)
_face("rep_meeting_breakdown", "H3", "rep_meeting_breakdown", outcomes.START, outcomes.END, flags=True)
