"""The daily reporting job: every report for one as-of date (E2 + E3).

The original ran its queries one by one into named in-memory frames and then
built each report from those frames.  Here the six shared query results are
computed once and checkpointed into the session's checkpoint folder (cutting
lineage, so a lost executor re-reads them instead of recomputing), and every
report is a small plan over them.

    python -m planpulse.plans.daily --tables DIR --as-of 2026-07-21 --task therapy \\
        --out DIR [--alias CSV] [--staff-map CSV] [--targets CSV] [--assessments CSV] [--feed DIR] [--facts DIR]
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planpulse import constants as K
from planpulse.functions.text import recode
from planpulse.operators.grouping import extreme_flags
from planpulse.plans.benchmarks import best_period, target_vs_achieved
from planpulse.plans.cycle import latest_roles, plan_cycle, plan_cycle_simple
from planpulse.plans.fact_store import FactStore, fact_rows
from planpulse.plans.mixes import branch_metric_table, duration_mix, order_source_mix, source_mix
from planpulse.plans.scorecards import (
    SCORECARD_METRICS, daily_facts, metric_facts, period_metrics_from_facts, report_periods, scorecard, staff_scorecard,
)
from planpulse.plans.snapshots import active_snapshots, lapsed_entities
from planpulse.plans.visits import sessions_by_staff, visits_classified
from planpulse.session import materialize


@dataclasses.dataclass
class ReportConfig:
    """Parameters of the daily job; defaults are the original's fixed values."""

    session_task: str                                   # roster task type counted as a session
    excluded_sources: Sequence[str] = K.EXCLUDED_SOURCES
    expired_status: str = K.EXPIRED_STATUS
    visit_statuses: Sequence[int] = K.COMPLETED_VISIT_STATUSES
    corporate_sources: Sequence[str] = K.CORPORATE_SOURCES
    grace_days: int = K.GRACE_DAYS
    snapshot_first_month: dt.date | None = None         # default: 12 months before as-of
    sessions_from: dt.date | None = None                # default: 1 January of as-of's year
    best_from: dt.date | None = None                    # default: 1 January of last month's year
    branch_recode: Mapping[str, str] = dataclasses.field(default_factory=dict)
    visit_keys: Sequence[str] = ("visit_id",)
    roles: Sequence[str] = K.STAFF_ROLES
    entity_kind: str = K.ENTITY_KIND                    # constant column of active, lapsed and visits


def _branch(df: DataFrame, col: str, cfg: ReportConfig) -> DataFrame:
    return df.withColumn("branch", recode(F.col(col), cfg.branch_recode, null_label=K.UNKNOWN_LABEL))


def shared_results(tables: Mapping[str, DataFrame], as_of: dt.date, cfg: ReportConfig,
                   checkpoint: bool = True) -> dict[str, DataFrame]:
    """The six query results every report reads (C1-C6), each computed once."""
    plans, entities, terms = tables["plans"], tables["entities"], tables.get("terms")
    visits = tables["visits"]
    first = cfg.snapshot_first_month or (as_of.replace(day=1) - dt.timedelta(days=365)).replace(day=1)
    out = {
        "active": active_snapshots(plans, tables["assignments"], entities, terms, first, as_of,
                                   cfg.excluded_sources, cfg.expired_status, tables.get("diagnoses"),
                                   entity_cols=("name",), entity_kind=cfg.entity_kind),
        "lapsed": lapsed_entities(plans, entities, terms, as_of, cfg.excluded_sources, entity_cols=("name",),
                                  assignments=tables["assignments"], diagnoses=tables.get("diagnoses"),
                                  entity_kind=cfg.entity_kind),
        "plan_cycle": plan_cycle(plans, entities, visits, as_of, cfg.grace_days,
                                 roles=latest_roles(tables["assignments"], visits, cfg.roles)
                                 if "role" in tables["assignments"].columns and "plan_id" in visits.columns else None,
                                 diagnoses=tables.get("diagnoses")),
        "plan_types": plan_cycle_simple(plans, entities, visits, terms, as_of, cfg.grace_days,
                                        cfg.excluded_sources, cfg.visit_keys),
        "visits": visits_classified(visits, entities, tables["prescriptions"], terms, as_of,
                                    cfg.visit_statuses, cfg.excluded_sources, cfg.visit_keys,
                                    entity_kind=cfg.entity_kind),
        "sessions": sessions_by_staff(tables["roster"], tables["roster_map"], entities,
                                      cfg.sessions_from or dt.date(as_of.year, 1, 1), as_of,
                                      cfg.session_task, cfg.corporate_sources),
    }
    if checkpoint:
        out = {k: materialize(v) for k, v in out.items()}
    return out


def report_facts(r: Mapping[str, DataFrame], cfg: ReportConfig, assessments: DataFrame | None = None) -> DataFrame:
    """The metric facts of ``shared_results``, branches recoded."""
    return metric_facts(_branch(r["visits"], "entity_branch", cfg), _branch(r["plan_types"], "entity_branch", cfg),
                        _branch(r["active"], "branch", cfg), _branch(r["lapsed"], "branch", cfg), assessments)


def entity_slice(tables: Mapping[str, DataFrame], changed: DataFrame) -> dict[str, DataFrame]:
    """``tables`` limited to the entities in ``changed`` (a column ``entity_id``).

    Visits, plans and their history belong to one entity, so the facts of a slice before and
    after a batch are all that ``FactStore.apply`` needs.  The day matters too: a later
    as-of day also moves entities whose plans run or end in between.
    """
    keys = changed.select("entity_id").dropna().distinct()
    out = {k: v.join(keys, "entity_id", "left_semi") if "entity_id" in v.columns else v for k, v in tables.items()}
    plan_ids = out["plans"].select("plan_id").dropna().distinct()
    for name in ("assignments", "diagnoses"):
        if name in out and "entity_id" not in out[name].columns:
            out[name] = out[name].join(plan_ids, "plan_id", "left_semi")
    return out


def daily_reports(tables: Mapping[str, DataFrame], as_of: dt.date, cfg: ReportConfig,
                  alias: DataFrame | None = None, staff_map: DataFrame | None = None,
                  targets: DataFrame | None = None, assessments: DataFrame | None = None,
                  feed: DataFrame | None = None, checkpoint: bool = True,
                  facts_path: str | None = None) -> dict[str, DataFrame]:
    """Every report of the original's two daily scripts, as DataFrames by name.

    With ``facts_path`` the daily facts are kept there from run to run: days that differ are
    rewritten, and the reports read the days of their periods only.

    What an input holds but no report can use is a result too, with its own row count:
    ``feed_rejects`` (pages and records, with the reason), ``feed_chain`` (pages missing or
    beyond the end, for a feed read by ``load_feed``) and ``assessment_rejects`` (rows whose
    date is no date, for assessments read by ``read_assessments``).
    """
    from planpulse.plans.feed import feed_sorted
    from planpulse.sources.feed import chain_problems
    spark = tables["plans"].sparkSession
    r = shared_results(tables, as_of, cfg, checkpoint)
    y = as_of - dt.timedelta(days=1)
    m0 = y.replace(day=1)
    smap = staff_map if staff_map is not None else spark.createDataFrame([], "staff_id string, staff_raw string")
    card_args = (r["visits"], r["sessions"], r["plan_cycle"], r["active"], r["lapsed"], smap, alias)
    out = dict(r)
    keep = materialize if checkpoint else (lambda df: df)   # each card is read again by its flags
    out["staff_yesterday"] = keep(staff_scorecard(*card_args, y, y))
    out["staff_mtd"] = keep(staff_scorecard(*card_args, m0, y))
    for name in ("staff_yesterday", "staff_mtd"):
        out[name + "_flags"] = extreme_flags(out[name], list(SCORECARD_METRICS), reverse=["inactive"])
    if assessments is not None and "date_text" in assessments.columns:
        assessments = keep(assessments)
        out["assessment_rejects"] = assessments.filter(F.col("date").isNull() & (F.col("date_text") != ""))
        assessments = assessments.dropna(subset=["date"]).drop("date_text")
    visits_b = _branch(r["visits"], "entity_branch", cfg)
    types_b = _branch(r["plan_types"], "entity_branch", cfg)
    best_from = cfg.best_from or (as_of.replace(day=1) - dt.timedelta(days=1)).replace(month=1, day=1)
    facts = report_facts(r, cfg, assessments)
    if facts_path:
        store = FactStore(spark, facts_path)
        store.sync(fact_rows(facts), as_of.isoformat())
        period_facts = store.read(min(d for d, _, _ in report_periods(as_of).values()), as_of)
        facts = store.read(best_from, as_of)
    else:
        facts = period_facts = keep(daily_facts(facts))
    metrics = period_metrics_from_facts(period_facts, as_of)
    best = best_period(facts, as_of, best_from)
    out["period_metrics"] = metrics
    out["scorecard"] = scorecard(metrics, targets)
    out["best_period"] = best
    out["target_vs_achieved"] = target_vs_achieved(metrics, best, targets, as_of)
    out["branch_table"] = branch_metric_table(metrics, best)
    branches = metrics.select("scope").filter(F.col("scope") != K.OVERALL_LABEL).distinct()
    out["duration_mix"] = duration_mix(types_b, as_of, branches)
    out["source_mix"] = order_source_mix(source_mix(visits_b, types_b, m0, y))
    if feed is not None:
        read = keep(feed_sorted(feed, as_of))       # the pages are parsed once for both parts
        out["feed"] = read.filter("reason IS NULL").drop("reason", "raw")
        out["feed_rejects"] = read.filter("reason IS NOT NULL").select("reason", "raw")
        if {"chain", "page"} <= set(feed.columns):
            out["feed_chain"] = chain_problems(feed)
    return out


#: Stored order of the result tables (O1): newest or latest first, then the entity.
STORED_ORDER = {
    "active": (F.desc, "active_date", "entity_id"),
    "lapsed": (F.desc, "inactive_date", "entity_id"),
    "visits": (F.desc, "visit_date", "entity_id"),
    "sessions": (F.asc, "slot_date", "staff_id"),
}


def stored_order(name: str, df: DataFrame) -> list:
    """Sort columns of a stored result, as far as it has them."""
    how, first, *rest = STORED_ORDER.get(name, (F.asc, None))
    return [how(first), *[F.asc(c) for c in rest if c in df.columns]] if first in df.columns else []


def write_daily_reports(reports: Mapping[str, DataFrame], out_dir: str, fmt: str = "parquet",
                        display_as_of: dt.date | None = None) -> dict[str, int]:
    """Publish each report under ``out_dir/name`` (replaced at once); returns row counts.

    With ``display_as_of`` the reports are written in display form (headings,
    formatted numbers, report order; ``plans.display``), e.g. as CSV.
    """
    from planpulse.sources.sinks import publish_report
    if display_as_of is not None:
        from planpulse.plans.display import display_reports
        reports = display_reports(dict(reports), display_as_of)
    return {name: publish_report(df, f"{out_dir.rstrip('/')}/{name}", fmt, order_by=stored_order(name, df))
            for name, df in reports.items()}


def main(argv: Sequence[str] | None = None) -> None:
    from planpulse.session import build_session
    from planpulse.sources import (
        load_alias_map, load_feed, load_staff_map, load_tables, load_targets, read_assessments,
    )
    ap = argparse.ArgumentParser(description="planpulse daily reports")
    ap.add_argument("--tables", required=True)
    ap.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    ap.add_argument("--task", required=True, help="roster task type counted as a session")
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--display", action="store_true", help="write headings and formatted numbers")
    ap.add_argument("--alias"), ap.add_argument("--staff-map"), ap.add_argument("--targets")
    ap.add_argument("--assessments"), ap.add_argument("--feed"), ap.add_argument("--master")
    ap.add_argument("--facts", metavar="DIR", help="folder of the daily facts, kept from run to run")
    ap.add_argument("--best-from", type=dt.date.fromisoformat, help="first month of the best-month search")
    ap.add_argument("--recode", action="append", default=[], metavar="RAW=LABEL", help="branch label (repeatable)")
    ap.add_argument("--center", action="append", default=[], metavar="RAW=LABEL", help="assessment centre (repeatable)")
    a = ap.parse_args(argv)
    spark = build_session(a.master) if a.master else SparkSession.builder.getOrCreate()
    tables = load_tables(spark, a.tables, skip_missing=True)
    reports = daily_reports(
        tables, a.as_of, ReportConfig(session_task=a.task, best_from=a.best_from,
                                      branch_recode=dict(x.split("=", 1) for x in a.recode)),
        alias=load_alias_map(spark, a.alias) if a.alias else None,
        staff_map=load_staff_map(spark, a.staff_map) if a.staff_map else None,
        targets=load_targets(spark, a.targets) if a.targets else None,
        assessments=read_assessments(spark, a.assessments, dict(x.split("=", 1) for x in a.center)) if a.assessments else None,
        feed=load_feed(spark, a.feed) if a.feed else None, facts_path=a.facts)
    shown = a.as_of if a.display else None
    for name, n in write_daily_reports(reports, a.out, a.format, display_as_of=shown).items():
        print(f"{name}: {n} rows")


if __name__ == "__main__":
    main()
