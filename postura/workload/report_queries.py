"""Queries of the maintained tables, sampling, scores and reports."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postura import schemas
from postura.functions.bands import rag_columns, rag_label
from postura.functions.numbers import percent, safe_ratio
from postura.functions.predicates import match_choices, match_criteria, match_present
from postura.operators import maintenance, pivots, rollups, sampling, scoring, selection
from postura.plans import alerts, reports
from postura.plans.catalogue import shipped_metrics
from postura.plans.publish import Store
from postura.session import scratch_path
from postura.sources.lineage import with_lineage
from postura.streaming import publish as streaming
from postura.workload.fixtures import AS_OF, YEAR_END, Fixtures
from postura.workload.registry import query

UNITS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
# Rows of a delivered file, about; a compressed one is read by one task.
FILE_ROWS = 500_000


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles depend on their order in the last digits; compare six decimals."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _sampled(f: Fixtures) -> DataFrame:
    return sampling.v_summary(f.stored_summary, YEAR_END)


# --- filters ---------------------------------------------------------------------------


@query("filter_criteria", "select * from f_summary where business_unit = 'ASIA'")
def filter_criteria(f: Fixtures):
    """A chart's rule: nothing chosen, be it 0 or False, is no filter."""
    unset = {"team": "", "location": None, "slo": 0.0, "weight": False}
    return match_criteria(f.summary, {"business_unit": "ASIA", **unset})


@query("filter_present", "select * from f_summary where totalok = 0")
def filter_present(f: Fixtures):
    """A weighted score's rule: 0 is a filter."""
    return match_present(f.summary, {"totalok": 0.0, "team": "", "location": None})


@query("filter_blank_choice", "select event_id, dim from f_nulls where dim = ''")
def filter_blank(f: Fixtures):
    """A report's rule: a blank choice matches blanks."""
    return match_choices(f.nulls, {"dim": "", "event_type": "All"}).select("event_id", "dim")


@query(
    "filter_all_sentinel",
    "select * from f_summary where metric_id = 'economy' and business_unit = 'EUROPE'",
)
def filter_all(f: Fixtures):
    chosen = {"category": "All", "metric_id": "economy", "business_unit": "EUROPE"}
    return match_choices(f.summary, chosen)


@query(
    "latest_date_filter",
    "select * from f_summary where datestamp = (select max(datestamp) from f_summary)",
)
def latest_date(f: Fixtures):
    return selection.latest_only(f.summary).select(*schemas.SUMMARY.fieldNames())


@query(
    "last_year_inclusive",
    "select * from f_summary where datestamp >= date '2001-11-04' - interval 1 year",
)
def last_year_inclusive(f: Fixtures):
    return selection.last_year(f.summary, YEAR_END)


@query(
    "last_year_exclusive",
    "select * from f_summary where datestamp > date '2001-11-04' - interval 1 year",
)
def last_year_exclusive(f: Fixtures):
    return selection.last_year(f.summary, YEAR_END, inclusive=False)


@query(
    "filter_options",
    """select distinct 'business_unit' as dimension, business_unit as value from f_summary
       union select 'team', team from f_summary union select 'location', location from f_summary""",
)
def filter_options(f: Fixtures):
    return selection.filter_options(f.summary)


@query(
    "select_series",
    "select datestamp, round(value, 6) as value, round(slo, 6) as slo from by_date",
)
def select_series(f: Fixtures):
    """The chart's columns; one it names does not exist."""
    trend = rounded(scoring.weighted_score(f.summary), "value", "slo")
    return selection.select_series(trend, "datestamp", ["value", "slo", "forecast"])


# --- maintained tables -----------------------------------------------------------------


@query("summary_rollup", "select * from f_summary")
def summary_rollup(f: Fixtures):
    return rollups.summarise(f.detail)


@query(
    "summary_rollup_drop_null_keys",
    """select * from f_summary where business_unit <> 'ASIA'""",
)
def summary_without_null_keys(f: Fixtures):
    """Rows without an owner are left out when NULL keys are dropped."""
    unit = F.when(F.col("business_unit") != "ASIA", F.col("business_unit"))
    return rollups.summarise(f.detail.withColumn("business_unit", unit), drop_null_keys=True)


@query(
    "metric_scores",
    """select metric_id, sum(compliance) as totalok, count(compliance) as total,
         round_even(sum(compliance) / count(compliance) * 100, 2) as score
       from f_detail group by metric_id""",
)
def metric_scores(f: Fixtures):
    return rollups.metric_scores(f.detail)


@query("alert_table", "select * replace (round(score, 6) as score) from alerts")
def alert_table(f: Fixtures):
    return rounded(rollups.alert_table(f.detail), "score")


@query("alert_lines", "select datestamp, metric_id, line from lines")
def alert_lines(f: Fixtures):
    lines = alerts.alert_lines(rollups.alert_table(f.detail))
    return lines.select("datestamp", "metric_id", "line")


@query(
    "alert_message",
    """select datestamp, concat('Automated Security Metric results:', chr(10),
         string_agg(line, chr(10) order by metric_id)) as message
       from lines group by datestamp""",
)
def alert_message(f: Fixtures):
    return alerts.alert_message(alerts.alert_lines(rollups.alert_table(f.detail)))


@query(
    "redact_detail",
    "select * replace ('redacted' as detail, 'redacted' as resource) from f_detail",
)
def redact(f: Fixtures):
    return maintenance.redact(f.detail)


@query(
    "summary_delete",
    """select * from f_old_summary
       where (metric_id, datestamp) not in (select metric_id, datestamp from f_run_detail)""",
)
def summary_delete(f: Fixtures):
    kept = maintenance.replace_keys(f.old_summary, f.run_detail, schemas.SUMMARY_REPLACE_KEYS)
    return kept.select(*schemas.SUMMARY.fieldNames())


@query(
    "detail_delete",
    "select * from f_old_detail where metric_id not in (select metric_id from f_run_detail)",
)
def detail_delete(f: Fixtures):
    kept = maintenance.replace_keys(f.old_detail, f.run_detail, schemas.DETAIL_REPLACE_KEYS)
    return kept.select(*schemas.DETAIL.fieldNames())


@query(
    "summary_upsert",
    """select * from f_old_summary
       where (metric_id, datestamp) not in (select metric_id, datestamp from f_run_detail)
       union all select datestamp, metric_id, title, category, slo, slo_min, weight, business_unit,
         team, location, sum(compliance) as totalok, count(compliance) as total
       from f_run_detail group by all""",
)
def summary_upsert(f: Fixtures):
    return maintenance.upsert_summary(f.old_summary, f.run_detail)


@query(
    "detail_upsert",
    """select * from f_old_detail where metric_id not in (select metric_id from f_run_detail)
       union all select * from f_run_detail""",
)
def detail_upsert(f: Fixtures):
    return maintenance.upsert_detail(f.old_detail, f.run_detail)


# --- generic pivot ---------------------------------------------------------------------


@query(
    "pivot_data",
    """select event_type, dim, round(sum(coalesce(measure, 0)), 6) as total, count(*) as n,
         round(sum(coalesce(measure, 0)) / count(*), 6) as mean,
         coalesce(max_by(coalesce(measure, 0), event_id), 0) as latest
       from f_nulls group by event_type, dim""",
)
def pivot_data(f: Fixtures):
    wanted = {
        "total": ("sum", "measure"),
        "n": ("count", "measure"),
        "mean": ("avg", "measure"),
        "latest": ("last", "measure"),
    }
    return rounded(
        pivots.pivot_data(f.nulls, ["event_type", "dim"], wanted, order_by="event_id"),
        "total",
        "mean",
    )


@query(
    "pivot_avg_zero",
    "select dim, round(sum(coalesce(measure, 0)) / count(*), 6) as mean from f_nulls group by dim",
)
def pivot_avg(f: Fixtures):
    return rounded(pivots.pivot_data(f.nulls, ["dim"], {"mean": ("avg", "measure")}), "mean")


@query(
    "pivot_sum_zero",
    "select dim, round(sum(coalesce(measure, 0)), 6) as total from f_nulls group by dim",
)
def pivot_sum(f: Fixtures):
    return rounded(pivots.pivot_data(f.nulls, ["dim"], {"total": ("sum", "measure")}), "total")


@query(
    "pivot_last",
    """select event_type, (select coalesce(l.measure, 0) from f_nulls l where l.event_id = last_id) as latest
       from (select event_type, max(event_id) as last_id from f_nulls group by event_type)""",
)
def pivot_last(f: Fixtures):
    return pivots.pivot_data(
        f.nulls, ["event_type"], {"latest": ("last", "measure")}, order_by="event_id"
    )


# --- sampling --------------------------------------------------------------------------


@query("date_rank", "select * from date_ranks")
def date_rank(f: Fixtures):
    return sampling.date_rank(f.summary, YEAR_END)


@query("v_summary", "select * from v_summary")
def v_summary(f: Fixtures):
    return _sampled(f)


@query(
    "v_summary_keep_latest",
    """select s.* from f_summary s join (
         select datestamp from (
           select datestamp, row_number() over (order by datestamp) as r, count(*) over () as n
           from date_candidates)
         where r < 12 or r = n) d using (datestamp)""",
)
def v_summary_keep_latest(f: Fixtures):
    return sampling.v_summary(f.stored_summary, YEAR_END, keep_latest=True)


@query(
    "summary_csv_sample",
    """select * from f_summary where datestamp in (
         select datestamp from (
           select datestamp, row_number() over (order by datestamp) - 1 as p, count(*) over () as n
           from f_summary where datestamp > date '2001-11-04' - interval 1 year)
         where n < 12 or p = 0 or p = n - 1
           or (p >= 1 and p < n - 1 and (p - 1) % ((n - 2) // 10) = 0 and (p - 1) // ((n - 2) // 10) < 10))""",
)
def summary_csv_sample(f: Fixtures):
    sample = sampling.summary_sample(f.stored_summary, YEAR_END)
    return sample.select(*schemas.SUMMARY.fieldNames())


# --- scores ----------------------------------------------------------------------------

_SCORE = "round(score, 6) as score, round(slo, 6) as slo, round(slo_min, 6) as slo_min"
_VALUE = "round(value, 6) as value, round(slo, 6) as slo, round(slo_min, 6) as slo_min"


@query("overview_trend", f"select datestamp, {_SCORE} from trend")
def overview_trend(f: Fixtures):
    return rounded(scoring.weighted_trend(_sampled(f)), "score", "slo", "slo_min")


@query("category_scores", f"select category, {_SCORE} from categories")
def category_scores(f: Fixtures):
    return rounded(scoring.weighted_categories(_sampled(f)), "score", "slo", "slo_min")


@query(
    "categories_ranked",
    f"""select category, {_SCORE}, row_number() over (order by score, category) as rank
        from categories""",
)
def categories_ranked(f: Fixtures):
    return rounded(scoring.categories_ranked(_sampled(f)), "score", "slo", "slo_min")


@query("weighted_score", f"select datestamp, {_VALUE} from by_date")
def weighted_score(f: Fixtures):
    return rounded(scoring.weighted_score(f.summary), "value", "slo", "slo_min")


@query("weighted_score_business_unit", f"select datestamp, business_unit, {_VALUE} from by_unit")
def weighted_unit(f: Fixtures):
    scores = scoring.weighted_score(f.summary, {}, "business_unit")
    return rounded(scores, "value", "slo", "slo_min")


@query("weighted_score_category", f"select datestamp, category, {_VALUE} from by_category")
def weighted_category(f: Fixtures):
    return rounded(scoring.weighted_score(f.summary, None, "category"), "value", "slo", "slo_min")


@query("weighted_score_metric", f"select datestamp, metric_id, {_VALUE} from by_metric")
def weighted_metric(f: Fixtures):
    return rounded(scoring.weighted_score(f.summary, None, "metric_id"), "value", "slo", "slo_min")


_CARD = "round(weight, 6) as weight, round(slo, 6) as slo, round(slo_min, 6) as slo_min, round(score, 6) as score"


@query("metric_cards", f"select * exclude (weight, slo, slo_min, score), {_CARD} from cards")
def metric_cards(f: Fixtures):
    return rounded(scoring.metric_cards(f.summary), "weight", "slo", "slo_min", "score")


@query(
    "cards_by_category",
    f"""select category, cast(row_number() over (partition by category order by title) as int) as place,
          * exclude (category, weight, slo, slo_min, score), {_CARD} from cards""",
)
def cards_by_category(f: Fixtures):
    """The nested cards, taken apart again to be compared."""
    nested = scoring.cards_by_category(f.summary)
    flat = nested.select("category", F.posexplode("cards").alias("pos", "card"))
    placed = flat.select("category", (F.col("pos") + 1).alias("place"), "card.*")
    return rounded(placed, "weight", "slo", "slo_min", "score")


@query(
    "documented_weighted_targets",
    """select datestamp, business_unit, round(sum(score * weight) / sum(weight), 6) as score_final,
         round(sum(slo * weight) / sum(weight), 6) as slo_final,
         round(sum(slo_min * weight) / sum(weight), 6) as slo_min_final
       from (select datestamp, business_unit, metric_id, sum(totalok) / sum(total) as score,
               avg(weight) as weight, avg(slo) as slo, avg(slo_min) as slo_min
             from f_summary group by all)
       group by all""",
)
def weighted_targets(f: Fixtures):
    targets = scoring.weighted_targets(f.summary, None, "business_unit")
    return rounded(targets, "score_final", "slo_final", "slo_min_final")


@query(
    "weight_totals",
    """select datestamp, metric_id, location, weight,
         round(sum(weight) over (partition by datestamp, location), 6) as sum_weight
       from (select datestamp, metric_id, location, max(weight) as weight from f_summary group by all)""",
)
def weight_totals(f: Fixtures):
    """Each metric's weight beside the weight total of its date and location."""
    keys = ["datestamp", "metric_id", "location"]
    weights = f.summary.groupBy(*keys).agg(F.max("weight").alias("weight"))
    return rounded(scoring.with_weight_total(weights, ["datestamp", "location"]), "sum_weight")


# --- numbers and bands -----------------------------------------------------------------


def _metric_days(f: Fixtures) -> DataFrame:
    days = f.summary.groupBy("datestamp", "metric_id").agg(
        F.sum("totalok").alias("totalok"),
        F.sum("total").alias("total"),
        F.max("slo").alias("slo"),
        F.max("slo_min").alias("slo_min"),
    )
    return days.withColumn("score", safe_ratio("totalok", "total"))


@query(
    "score_percent",
    """select datestamp, metric_id, round_even(score * 100, 2) as console, round_even(score * 100, 0) as alert,
         floor(score * 100 * 100 + 0.5) / 100 as chart, floor(score * 100 + 0.5) as card
       from metric_days""",
)
def score_percent(f: Fixtures):
    return _metric_days(f).select(
        "datestamp",
        "metric_id",
        percent("score", 2).alias("console"),
        percent("score", 0).alias("alert"),
        percent("score", 2, "half_up").alias("chart"),
        percent("score", 0, "half_up").alias("card"),
    )


_BANDS = """
    round(case when score < slo_min then score end, 6) as red,
    round(case when score >= slo_min and score < slo then score end, 6) as amber,
    round(case when score >= slo then score end, 6) as green"""


@query("rag_columns", f"select datestamp, metric_id, {_BANDS} from metric_days")
def bands(f: Fixtures):
    banded = _metric_days(f).withColumns(rag_columns())
    colours = rounded(banded, "red", "amber", "green")
    return colours.select("datestamp", "metric_id", "red", "amber", "green")


@query(
    "rag_label",
    """select datestamp, metric_id, case when score >= slo then 'success'
         when score >= slo_min then 'warning' else 'error' end as status
       from metric_days""",
)
def labels(f: Fixtures):
    return _metric_days(f).select("datestamp", "metric_id", rag_label().alias("status"))


# --- reports ---------------------------------------------------------------------------


@query("overview_rag", f"select datestamp, {_BANDS} from trend")
def overview_rag(f: Fixtures):
    return rounded(reports.overview_rag(_sampled(f)), "red", "amber", "green")


@query("categories_rag", f"select category, {_BANDS} from categories")
def categories_rag(f: Fixtures):
    return rounded(reports.categories_rag(_sampled(f)), "red", "amber", "green")


@query(
    "chart_wide",
    """select datestamp,
         round(coalesce(max(value) filter (category = 'Identity Management'), 0), 6) as "Identity Management",
         round(coalesce(max(value) filter (category = 'Software Development'), 0), 6) as "Software Development",
         round(coalesce(max(value) filter (category = 'User Security'), 0), 6) as "User Security",
         round(coalesce(max(value) filter (category = 'Vulnerability Management'), 0), 6)
           as "Vulnerability Management"
       from by_category group by datestamp""",
)
def chart_wide(f: Fixtures):
    """One column per category, the names looked up in the data."""
    scores = rounded(scoring.weighted_score(f.summary, None, "category"), "value")
    return pivots.chart_wide(scores, "datestamp", ["value"], "category", all_series=True)


@query(
    "chart_map",
    """select d.datestamp, c.category, round(coalesce(value, 0), 6) as value
       from (select distinct datestamp from by_category) d
       cross join (select distinct category from by_category) c
       left join by_category using (datestamp, category)""",
)
def chart_map(f: Fixtures):
    """The same points as a map for each date, in one pass: holes are zeros."""
    scores = rounded(scoring.weighted_score(f.summary, None, "category"), "value")
    wide = pivots.chart_map(scores, "datestamp", "value", "category", all_series=True)
    return wide.select("datestamp", F.explode("series").alias("category", "value"))


@query(
    "series_latest",
    """select category, round(value, 6) as value from by_category c
       where datestamp = (select max(datestamp) from by_category m where m.category = c.category)""",
)
def series_latest(f: Fixtures):
    scores = scoring.weighted_score(f.summary, None, "category")
    return rounded(pivots.series_latest(scores, "datestamp", "value", "category"), "value")


@query(
    "overview_page_organisation",
    f"select datestamp, {_VALUE} from by_date",
)
def overview_organisation(f: Fixtures):
    page = reports.overview_page(f.summary, business_units=UNITS)
    return rounded(page["organisation"], "value", "slo", "slo_min")


@query(
    "overview_page_bu",
    "select datestamp, "
    + ", ".join(
        f"""round(coalesce(max(value) filter (business_unit = '{u}'), 0), 6) as "{u}" """
        for u in UNITS
    )
    + " from by_unit group by datestamp",
)
def overview_units(f: Fixtures):
    page = reports.overview_page(f.summary, business_units=UNITS)
    return rounded(page["business_units"], *UNITS)


@query(
    "category_sparkline",
    """select category, datestamp, round(value, 6) as value,
         (select floor(max_by(l.value, l.datestamp) * 100 * 100 + 0.5) / 100
          from by_category l where l.category = c.category) as gauge
       from by_category c""",
)
def category_sparkline(f: Fixtures):
    return rounded(reports.category_sparkline(f.summary), "value")


@query("metric_page", f"select datestamp, {_VALUE} from by_one_metric")
def metric_page(f: Fixtures):
    return rounded(reports.metric_page(f.summary, "economy"), "value", "slo", "slo_min")


@query(
    "metrics_page",
    """select category, metric_id, title, cast(floor(score * 100 + 0.5) as bigint) as score_percent,
         cast(floor(slo * 100 + 0.5) as bigint) as target_percent,
         case when score >= slo then 'success' when score >= slo_min then 'warning' else 'error' end as status,
         (select floor(max_by(l.value, l.datestamp) * 100 * 100 + 0.5) / 100
          from by_category l where l.category = c.category) as category_score
       from cards c""",
)
def metrics_page(f: Fixtures):
    return reports.metrics_page(f.summary)


# --- streaming -------------------------------------------------------------------------


def deliver_json(rows: DataFrame, path: str) -> None:
    """Put records among those delivered, as compressed files: repeated names and values take little room."""
    rows.write.mode("append").option("compression", "gzip").json(path)


def in_files(rows: DataFrame, most: int) -> DataFrame:
    """``rows``, of which there are ``most``, in files of about ``FILE_ROWS``.

    The rows alone decide on the file, so what is delivered again comes in the same files.
    """
    return rows.repartition(math.ceil(most / FILE_ROWS) or 1, *rows.columns)


class _Stream:
    """A folder rows are delivered to, and the summary log streamed from it."""

    def __init__(self, f: Fixtures) -> None:
        self.spark = f.spark
        self.landed = scratch_path(f.spark, "stream_in")
        self.log = scratch_path(f.spark, "stream_log")
        self.checkpoint = scratch_path(f.spark, "stream_state")

    def deliver(self, rows: DataFrame, files_per_batch: int | None = None) -> None:
        deliver_json(rows, self.landed)
        arriving = streaming.stream_rows(self.spark, self.landed, files_per_batch=files_per_batch)
        streaming.stream_publish(arriving, self.log, self.checkpoint).awaitTermination()


@query("stream_summary_upsert", "select * from f_summary")
def stream_upsert(f: Fixtures):
    """A first delivery gets three metrics' July wrong; a second one replaces those."""
    in_july = F.col("datestamp").between("2001-07-01", "2001-07-31")
    wrong = in_july & F.col("metric_id").isin("economy", "large", "small")
    compliance = F.when(wrong, 1 - F.col("compliance")).otherwise(F.col("compliance"))
    stream = _Stream(f)
    stream.deliver(f.detail.withColumn("compliance", compliance))
    stream.deliver(f.run_detail)
    return streaming.replaced_summary(f.spark, stream.log)


@query("stream_summary_accumulate", "select * from f_summary")
def stream_sum(f: Fixtures):
    """Metric-days spread over files and batches: partial sums are added up."""
    stream = _Stream(f)
    at_once = max(2, f.spark.sparkContext.defaultParallelism)  # a compressed file is one task
    stream.deliver(f.detail.repartition("resource"), files_per_batch=at_once)
    return streaming.accumulated_summary(f.spark, stream.log)


def _stream_raw(
    f: Fixtures, tag: str, deliveries: list[DataFrame], metric_ids: set[str], store: Store | None = None
) -> DataFrame:
    """The summary after each delivery has been streamed in."""
    landed, root, state = (scratch_path(f.spark, n) for n in ("stream_in", "stream_raw", "stream_state"))
    store = store or Store(scratch_path(f.spark, "stream_store"))
    metrics = [d for d in shipped_metrics() if d.metric_id in metric_ids]
    for rows in deliveries:
        deliver_json(rows, landed)
        arriving = streaming.stream_rows(f.spark, landed, schemas.RAW[tag])
        streaming.stream_metrics(
            arriving, tag, metrics, f.raw, AS_OF, root, store, state, f.assets
        ).awaitTermination()
    return store.read_summary(f.spark)


USER_METRICS = ("identity_credentials", "identity_dormant", "user_awareness")
FIRST, SECOND = "2001-08-01 00:00:00", "2001-08-02 00:00:00"


@query("stream_metric_run", f"select * from m_summary where metric_id in {USER_METRICS}")
def stream_metric_run(f: Fixtures):
    """Users of three tenancies in turn; one delivers again, and its first delivery comes once more."""
    place = F.concat(F.lit("t"), F.crc32(F.col("profile.login").cast("binary")) % 3)
    users = with_lineage(f.users, place, FIRST, "upload-1")
    tenancy = [users.filter(F.col("_tenancy") == t) for t in ("t0", "t1", "t2")]
    wrong = tenancy[0].withColumn("last_login", F.lit("1990-01-01"))
    right = tenancy[0].withColumn("_upload_timestamp", F.lit(SECOND).cast("timestamp"))
    deliveries = [wrong, tenancy[1], right, tenancy[2], wrong]
    return _stream_raw(f, "okta_users", deliveries, set(USER_METRICS))


@query("stream_split_upload", f"select * from m_summary where metric_id in {USER_METRICS}")
def stream_split_upload(f: Fixtures):
    """Uploads in several files and triggers: parts add up, a part that comes again does not."""
    place = F.concat(F.lit("t"), F.crc32(F.col("profile.login").cast("binary")) % 2)
    users = with_lineage(f.users, place, FIRST, "upload-1")
    one, other = (users.filter(F.col("_tenancy") == t) for t in ("t0", "t1"))
    half = F.crc32(F.reverse("profile.login").cast("binary")) % 2 == 0
    newer = one.withColumns({"_upload_timestamp": F.lit(SECOND).cast("timestamp"), "_upload_id": F.lit("upload-2")})
    wrong = one.withColumn("last_login", F.lit("1990-01-01"))
    deliveries = [
        wrong, other.filter(half), newer.filter(half), other.filter(~half), newer.filter(~half),
        other.filter(half), wrong.filter(half), newer.filter(half),
    ]
    most = f.table("customer").count()
    return _stream_raw(f, "okta_users", [in_files(d, most) for d in deliveries], set(USER_METRICS))


@query("stream_findings_run", "select * from m_summary where metric_id like 'vulnerabilities%'")
def stream_findings_run(f: Fixtures):
    """Findings of three tenancies, one by one: a host keeps what another tenancy found."""
    place = F.concat(F.lit("t"), F.col("created_timestamp").substr(10, 1).cast("int") % 3)
    vulns = with_lineage(f.vulns, place, FIRST, "upload-1")
    deliveries = [vulns.filter(F.col("_tenancy") == t) for t in ("t0", "t1", "t2")]
    metrics = {d.metric_id for d in shipped_metrics() if d.family}
    return _stream_raw(f, "crowdstrike_vulnerabilities", deliveries, metrics)


@query("stream_findings_changes", "select * from m_summary where metric_id like 'vulnerabilities%'")
def stream_findings_changes(f: Fixtures):
    """A tenancy's findings are replaced by others, in two parts; an older upload comes late."""
    place = F.concat(F.lit("t"), F.col("created_timestamp").substr(10, 1).cast("int") % 2)
    vulns = with_lineage(f.vulns, place, FIRST, "upload-1")
    one, other = (vulns.filter(F.col("_tenancy") == t) for t in ("t0", "t1"))
    newer = one.withColumn("_upload_timestamp", F.lit(SECOND).cast("timestamp"))
    odd = F.col("aid").cast("bigint") % 2 == 1
    closed = one.withColumn("status", F.when(odd, "open").otherwise("closed"))
    deliveries = [closed, other.filter(odd), newer.filter(odd), other.filter(~odd), newer.filter(~odd), closed]
    metrics = {d.metric_id for d in shipped_metrics() if d.family}
    most = f.table("orders").count()
    return _stream_raw(f, "crowdstrike_vulnerabilities", [in_files(d, most) for d in deliveries], metrics)


@query("stream_issues_and_trainings", "select * from m_summary where metric_id in ('development_vulnerabilities', 'user_awareness')")
def stream_issues_and_trainings(f: Fixtures):
    """Two streams into one store, each keeping its own metric up to date."""
    half = F.crc32(F.col("completion_date").cast("binary")) % 2 == 0
    trainings = with_lineage(f.enrollments, "t0", FIRST, "upload-1")
    issues = with_lineage(f.issues, "t0", FIRST, "upload-1")
    wrong = issues.withColumn("attributes", F.col("attributes").withField("status", F.lit("open")))
    right = issues.withColumn("_upload_timestamp", F.lit(SECOND).cast("timestamp"))
    store = Store(scratch_path(f.spark, "stream_store"))
    most = f.table("lineitem").count()
    _stream_raw(f, "snyk_issues", [in_files(d, most) for d in (wrong, right)], {"development_vulnerabilities"}, store)
    most = f.table("orders").count()
    halves = [in_files(trainings.filter(h), most) for h in (half, ~half)]
    return _stream_raw(f, "knowbe4_enrollments", halves, {"user_awareness"}, store)
