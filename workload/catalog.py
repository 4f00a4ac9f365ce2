"""Queries over the given tables, each with the SQL that states its result."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import Store, apply_batch, read_change_stream, requeue, run_keyset, run_queue, run_stream
from tidemark.operators import audit, mapping
from tidemark.operators.image import apply_final, final_image, merge_image
from tidemark.operators.links import dense_ids, link_failures, links_cascade, links_new, new_ids
from tidemark.operators.replay import flag_quarantined, replay
from tidemark.operators.skew import SkewPolicy
from tidemark.plans.cycle import pending
from tidemark.sources.changelog import keyset_page, late_changes, page_borders, queue_page, scan_changes, up_to
from tidemark.sources.generate import generate_from
from tidemark.sources.scratch import Scratch, shared_dir
from tidemark.spec import Mapping

from .logs import BAD_LINK, event_columns, event_log, event_spec, line_log, line_spec, order_log, order_spec, table
from .sql import EVENT_LOG, LINE_LOG, ORDER_LOG, imaged, replayed, with_

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BATCH = 1_000
# Two keys hold the whole log: cut into slices, whose summaries are chained in more than one level.
STATUS_HOT = SkewPolicy(hot_rows=1_000, sample=1.0, slice_rows=500, chain=4)
# Treats the busiest keys of the given tables as hot, to run the path meant for huge ones.
SMALL_HOT = SkewPolicy(hot_rows=60, sample=1.0, slice_rows=500)


def query(sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        name = fn.__name__.removesuffix("_query")
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        ORACLES[name] = sql
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Types that both engines hand over alike: text dates, double amounts, 0/1 flags."""
    out = []
    for f in df.schema.fields:
        column = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, T.BooleanType):
            column = column.cast("int")
        out.append(column.alias(f.name))
    return df.select(*out)


def text_key(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that may be blank as text."""
    return df.withColumns({k: F.col(k).cast("string") for k in keys})


ORDER_VALUES = """customer_name, CAST(order_date AS VARCHAR) AS order_date,
       CAST(total_amount AS DOUBLE) AS total_amount, status, region"""
ORDER_NAMES = "customer_name, order_date, total_amount, status, region"
EVENT_ON = replayed(EVENT_LOG, "user_id")
EVENT_OFF = replayed(EVENT_LOG, "user_id", quarantine=False)
ORDER_ON = replayed(ORDER_LOG, "order_id")
ORDER_OFF = replayed(ORDER_LOG, "order_id", quarantine=False)
LINE_ON = replayed(LINE_LOG, "l_orderkey, l_linenumber")
ORDER_IMAGE = ORDER_ON + ",\n" + imaged("order_id", ORDER_NAMES)
EVENT_IMAGE = EVENT_OFF + ",\n" + imaged("user_id", "k, amount")
LINE_IMAGE = LINE_ON + ",\n" + imaged("l_orderkey, l_linenumber", "quantity, price")


# -- reshaping, routing, validity ------------------------------------------------


@query(with_(ORDER_LOG, f"""
SELECT change_id, order_id, {ORDER_VALUES}, CAST(reason IS NULL AS INTEGER) AS ok
FROM elog WHERE op = 'I'"""))
def map_insert(spark, sf_dir):
    return mapping.map_insert(order_log(spark, sf_dir), order_spec())


@query(with_(ORDER_LOG, f"""
SELECT change_id, order_id, {ORDER_VALUES}, CAST(reason IS NULL AS INTEGER) AS ok
FROM elog WHERE op = 'U'"""))
def map_update(spark, sf_dir):
    return mapping.map_update(order_log(spark, sf_dir), order_spec())


@query(with_(ORDER_LOG, "SELECT change_id, order_id FROM elog WHERE op = 'D'"))
def map_delete(spark, sf_dir):
    return mapping.map_delete(order_log(spark, sf_dir), order_spec())


@query(with_(EVENT_LOG, """
SELECT change_id, op, CASE WHEN op <> 'X' THEN op END AS kind FROM elog"""))
def route_ops(spark, sf_dir):
    rows = mapping.route(event_log(spark, sf_dir), event_spec())
    return rows.select("change_id", F.col(mapping.OP).alias("op"), F.col(mapping.KIND).alias("kind"))


@query(with_(EVENT_LOG, """
SELECT change_id, 'unknown operation value ''' || op || '''' AS detail FROM elog WHERE op = 'X'"""))
def bad_ops(spark, sf_dir):
    return mapping.bad_ops(event_log(spark, sf_dir), event_spec())


@query(with_(ORDER_LOG, "SELECT change_id, op AS kind, reason FROM elog"))
def row_validity(spark, sf_dir):
    return mapping.row_validity(order_log(spark, sf_dir), order_spec())


@query(with_(EVENT_LOG, """
SELECT count(*) FILTER (WHERE op NOT IN ('I', 'U', 'D')) AS bad_op,
       count(*) FILTER (WHERE user_id IS NULL) AS null_key,
       count(*) FILTER (WHERE change_id IS NULL) AS null_order,
       count(*) FILTER (WHERE processed NOT IN (0, 1)) AS bad_flag
FROM elog"""))
def check_violations(spark, sf_dir):
    return mapping.check_violations(event_log(spark, sf_dir), event_spec(processed_column="processed"))


# -- replay ------------------------------------------------------------------------


@query(with_(EVENT_ON, "SELECT change_id, user_id, outcome, detail FROM done"))
def replay_outcomes(spark, sf_dir):
    rows = replay(event_log(spark, sf_dir), event_spec())
    return rows.select("change_id", "user_id", "outcome", "detail")


@query(with_(EVENT_OFF, "SELECT change_id, user_id, outcome, detail FROM done"))
def replay_without_quarantine(spark, sf_dir):
    rows = replay(event_log(spark, sf_dir), event_spec(quarantine=False))
    return rows.select("change_id", "user_id", "outcome", "detail")


@query(with_(EVENT_ON, "SELECT change_id, user_id, outcome, detail FROM done"))
def replay_hot_keys(spark, sf_dir):
    rows = replay(event_log(spark, sf_dir), event_spec(), skew=SMALL_HOT)
    return rows.select("change_id", "user_id", "outcome", "detail")


STATUS_OFF = replayed(LINE_LOG, "l_linestatus", quarantine=False)


@query(with_(STATUS_OFF, "SELECT change_id, l_linestatus, outcome, detail FROM done"))
def replay_status_keys(spark, sf_dir):
    """Half of all rows on one business key."""
    spec = line_spec(business_keys=("l_linestatus",), quarantine=False)
    rows = replay(line_log(spark, sf_dir), spec, skew=STATUS_HOT)
    return rows.select("change_id", "l_linestatus", "outcome", "detail")


@query(with_(STATUS_OFF + ",\n" + imaged("l_linestatus", "quantity, price"), """
SELECT row_id AS line_id, l_linestatus, quantity, price FROM img"""))
def apply_status_keys(spark, sf_dir):
    spec = line_spec(business_keys=("l_linestatus",), quarantine=False)
    return apply_final(line_log(spark, sf_dir), spec, skew=STATUS_HOT)


@query(with_(ORDER_ON, "SELECT change_id, order_id, outcome, detail FROM done"))
def replay_orders(spark, sf_dir):
    rows = replay(order_log(spark, sf_dir), order_spec())
    return rows.select("change_id", "order_id", "outcome", "detail")


@query(with_(LINE_ON, "SELECT change_id, l_orderkey, l_linenumber, outcome FROM done"))
def composite_key(spark, sf_dir):
    rows = replay(line_log(spark, sf_dir), line_spec())
    return rows.select("change_id", "l_orderkey", "l_linenumber", "outcome")


@query(with_(
    replayed(EVENT_LOG, "user_id", quarantine=False, on_duplicate="upsert", on_missing="upsert"),
    "SELECT change_id, user_id, outcome, CAST(effective AS INTEGER) AS effective FROM done"))
def replay_upserts(spark, sf_dir):
    spec = event_spec(quarantine=False, on_duplicate="upsert", on_missing="upsert")
    return replay(event_log(spark, sf_dir), spec).select("change_id", "user_id", "outcome", "effective")


@query(with_(EVENT_OFF, """
SELECT change_id, CAST(present AS INTEGER) AS present FROM done WHERE op IN ('I', 'U', 'D')"""))
def presence_before(spark, sf_dir):
    rows = replay(event_log(spark, sf_dir), event_spec(quarantine=False))
    return rows.where("kind is not null").select("change_id", "present")


@query(with_(EVENT_ON, """
SELECT change_id, user_id, CAST(quarantined AS INTEGER) AS quarantined FROM done
WHERE op IN ('I', 'U', 'D')"""), )
def flag_quarantined_query(spark, sf_dir):
    return flag_quarantined(event_log(spark, sf_dir), event_spec())


@query(with_(EVENT_OFF, """
SELECT change_id, user_id, detail FROM done WHERE op = 'I' AND present AND reason IS NULL"""))
def dup_inserts(spark, sf_dir):
    rows = replay(event_log(spark, sf_dir), event_spec(quarantine=False))
    duplicates = rows.where("insert_failed and reason is null")
    return duplicates.select("change_id", "user_id", "detail")


@query(with_(ORDER_ON, "SELECT outcome, count(*) AS \"rows\" FROM done GROUP BY outcome"))
def outcome_totals(spark, sf_dir):
    return audit.outcome_totals(replay(order_log(spark, sf_dir), order_spec()))


# -- target, ids, links --------------------------------------------------------------


@query(with_(ORDER_IMAGE, f"SELECT row_id AS summary_id, order_id, {ORDER_VALUES} FROM img"))
def apply_final_query(spark, sf_dir):
    return apply_final(order_log(spark, sf_dir), order_spec())


@query(with_(EVENT_IMAGE, "SELECT row_id AS profile_id, user_id, CAST(k AS VARCHAR) AS k, amount FROM img"))
def apply_final_events(spark, sf_dir):
    return text_key(apply_final(event_log(spark, sf_dir), event_spec(quarantine=False)), "k")


@query(with_(EVENT_IMAGE, "SELECT row_id AS profile_id, user_id, CAST(k AS VARCHAR) AS k, amount FROM img"))
def apply_hot_keys(spark, sf_dir):
    spec = event_spec(quarantine=False)
    return text_key(apply_final(event_log(spark, sf_dir), spec, skew=SMALL_HOT), "k")


@query(with_(LINE_IMAGE, """
SELECT row_id AS line_id, l_orderkey, l_linenumber, quantity, price FROM img"""))
def apply_composite_key(spark, sf_dir):
    return apply_final(line_log(spark, sf_dir), line_spec())


@query(with_(EVENT_IMAGE, "SELECT row_id AS profile_id, user_id, CAST(k AS VARCHAR) AS k, amount FROM img"))
def apply_in_two_cycles(spark, sf_dir):
    """The second half of the log over the target that the first half left."""
    spec, log = event_spec(quarantine=False), event_log(spark, sf_dir)
    middle = log.agg((F.max("change_id") / 2).cast("long")).first()[0]
    first = merge_image(None, final_image(log.where(F.col("change_id") <= middle), spec), spec)
    second = final_image(keyset_page(log, spec, middle), spec, first)
    return text_key(merge_image(first, second, spec), "k")


@query(with_(replayed(EVENT_LOG, "user_id", quarantine=False) + """,
u1 AS (SELECT *, count(*) FILTER (WHERE outcome = 'DELETED') OVER (PARTITION BY user_id ORDER BY change_id) AS gen
       FROM done),
u2 AS (SELECT *, max(gen) OVER (PARTITION BY user_id) AS last_gen FROM u1)""", """
SELECT min(change_id) FILTER (WHERE outcome = 'INSERTED') AS profile_id, user_id,
       CAST(last(k ORDER BY change_id) FILTER (WHERE effective) AS VARCHAR) AS k,
       last(amount ORDER BY change_id) FILTER (WHERE outcome = 'INSERTED') AS amount
FROM u2 WHERE gen = last_gen GROUP BY user_id HAVING count(*) FILTER (WHERE effective) > 0"""))
def partial_update(spark, sf_dir):
    """Updates that set one column leave the other as the insert wrote it."""
    spec = event_spec(quarantine=False, update=Mapping({"k": ":K"}, {"k": "coalesce(:K, 99) >= 98"}))
    return text_key(apply_final(event_log(spark, sf_dir), spec), "k")


@query(with_(EVENT_ON, """
SELECT change_id, user_id, change_id AS profile_id FROM done WHERE outcome = 'INSERTED'"""))
def new_ids_query(spark, sf_dir):
    spec = event_spec()
    return new_ids(replay(event_log(spark, sf_dir), spec), spec)


@query(with_(EVENT_ON, """
SELECT change_id, user_id, row_number() OVER (ORDER BY change_id) AS profile_id
FROM done WHERE outcome = 'INSERTED'"""))
def dense_ids_query(spark, sf_dir):
    spec = event_spec()
    return dense_ids(replay(event_log(spark, sf_dir), spec), spec)


@query(with_(ORDER_ON, """
SELECT change_id AS link_id, change_id AS summary_id, 'u-100' AS user_id, 'orders' AS user_section
FROM done WHERE outcome = 'INSERTED'"""))
def links_new_query(spark, sf_dir):
    spec = order_spec()
    return links_new(replay(order_log(spark, sf_dir), spec), spec)


@query(with_(ORDER_IMAGE, """
SELECT row_id AS link_id, row_id AS summary_id, 'u-100' AS user_id, 'orders' AS user_section FROM img"""))
def links_cascade_query(spark, sf_dir):
    spec, log = order_spec(), order_log(spark, sf_dir)
    return links_cascade(links_new(replay(log, spec), spec), apply_final(log, spec), spec)


@query(with_(replayed(ORDER_LOG, "order_id", link_detail="link:user_id"), """
SELECT change_id, order_id, outcome, detail FROM done WHERE outcome = 'LINK_FAILED'"""))
def link_failed(spark, sf_dir):
    rows = link_failures(replay(order_log(spark, sf_dir), order_spec(link=BAD_LINK)), order_spec(link=BAD_LINK))
    return rows.select("change_id", "order_id", "outcome", "detail")


@query(with_(ORDER_IMAGE, f"""
SELECT row_id AS summary_id, order_id, {ORDER_VALUES}, row_id AS link_id, 'u-100' AS user_id FROM img"""))
def target_with_links(spark, sf_dir):
    """Target rows beside their link, as one would inspect them after a run."""
    spec, log = order_spec(), order_log(spark, sf_dir)
    image = apply_final(log, spec)
    links = links_new(replay(log, spec), spec).select("link_id", "summary_id", "user_id")
    return image.join(links, "summary_id")


@query(with_(ORDER_IMAGE, f"SELECT order_id, row_id AS summary_id, {ORDER_VALUES} FROM img ORDER BY order_id"))
def target_view(spark, sf_dir):
    """The target by business key."""
    return apply_final(order_log(spark, sf_dir), order_spec()).orderBy("order_id")


@query(with_(ORDER_IMAGE, """
SELECT row_id AS link_id, row_id AS summary_id, 'u-100' AS user_id, 'orders' AS user_section
FROM img ORDER BY link_id"""))
def link_view(spark, sf_dir):
    """The link table by its id."""
    return links_cascade_query(spark, sf_dir).orderBy("link_id")


# -- history, quarantine, marks --------------------------------------------------------

HISTORY = """SELECT change_id, CASE WHEN outcome <> 'SKIPPED_BADROW' THEN CAST(user_id AS VARCHAR) END AS user_id,
       op AS operation, outcome, substring(detail, 1, 400) AS detail FROM {0}"""


@query(with_(EVENT_ON, HISTORY.format("done")))
def history_rows(spark, sf_dir):
    spec = event_spec()
    return text_key(audit.history_rows(replay(event_log(spark, sf_dir), spec), spec), "user_id")


@query(with_(
    EVENT_ON + ",\n" + replayed("", "user_id", quarantine=False, prefix="o_"),
    HISTORY.format("done") + " WHERE outcome <> 'SKIPPED_QUARANTINED'\nUNION ALL\n"
    + HISTORY.format("o_done WHERE change_id IN "
                     "(SELECT change_id FROM done WHERE outcome = 'SKIPPED_QUARANTINED')")))
def history_merge(spark, sf_dir):
    """Changes skipped at first are processed again with quarantine off and take the new record."""
    spec, off, log = event_spec(), event_spec(quarantine=False), event_log(spark, sf_dir)
    first = audit.history_rows(replay(log, spec), spec)
    again = audit.history_rows(replay(log, off), off)
    skipped = first.where("outcome = 'SKIPPED_QUARANTINED'").select("change_id")
    fresh = again.join(skipped, "change_id", "left_semi")
    return text_key(audit.history_merge(first, fresh, spec), "user_id")


@query(with_(EVENT_OFF, """
SELECT change_id, user_id, op AS operation, outcome, detail FROM done
WHERE op <> 'X' AND user_id = (SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)"""))
def history_trace(spark, sf_dir):
    """The life of the busiest key."""
    spec, log = event_spec(quarantine=False), event_log(spark, sf_dir)
    busiest = log.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").first()[0]
    history = audit.history_rows(replay(log, spec), spec)
    return audit.history_trace(history, spec, busiest)


@query(with_(ORDER_ON, """
SELECT change_id, order_id, op AS operation, outcome, detail FROM done
WHERE order_id IN (SELECT order_id FROM done WHERE ifail)"""))
def history_for_keys(spark, sf_dir):
    """Records of all keys that were quarantined."""
    spec = order_spec()
    outcomes = Scratch(spark).write(
        replay(order_log(spark, sf_dir), spec).select(
            "change_id", "order_id", "op_text", "outcome", "detail", "insert_failed"
        )
    )
    history = audit.history_rows(outcomes, spec)
    return audit.history_for_keys(history, audit.quarantine_new(outcomes, spec), spec)


@query(with_(EVENT_ON, """
SELECT user_id, min(change_id) AS change_id FROM done WHERE ifail AND NOT quarantined GROUP BY user_id"""))
def quarantine_new(spark, sf_dir):
    spec = event_spec()
    return audit.quarantine_new(replay(event_log(spark, sf_dir), spec), spec)


EARLIER = "SELECT DISTINCT user_id FROM elog WHERE op = 'D' AND k >= 95"


def _earlier_quarantine(log):
    """A quarantine table as an earlier run might have left it, with repeats."""
    return log.where("operation = 'D' and k >= 95").select("user_id")


@query(with_(EVENT_LOG, EARLIER))
def quarantine_keys(spark, sf_dir):
    return audit.quarantine_keys(_earlier_quarantine(event_log(spark, sf_dir)), event_spec())


@query(with_(EVENT_ON, EARLIER + " UNION SELECT user_id FROM done WHERE ifail AND NOT quarantined"))
def quarantine_merge(spark, sf_dir):
    spec, log = event_spec(), event_log(spark, sf_dir)
    held = audit.quarantine_keys(_earlier_quarantine(log), spec)
    return audit.quarantine_merge(held, audit.quarantine_new(replay(log, spec), spec), spec)


# A queue cycle: pending rows whose key is not held, replayed over the quarantine held so far.
CYCLE = f"""{EVENT_LOG},
held AS ({EARLIER}),
page AS (SELECT * FROM elog WHERE processed = 0 AND user_id NOT IN (SELECT user_id FROM held)),
{replayed("", "user_id", source="page")},
after AS (SELECT user_id FROM held UNION SELECT user_id FROM done WHERE ifail),
marked AS (SELECT change_id FROM done WHERE op = 'X' OR user_id NOT IN (SELECT user_id FROM after))"""


def _cycle(spark, sf_dir):
    spec, log = event_spec(processed_column="processed"), event_log(spark, sf_dir)
    held = audit.quarantine_keys(_earlier_quarantine(log), spec)
    outcomes = replay(queue_page(log, spec, held), spec, quarantine=held)
    # Used twice from here on: for the new quarantine and for the marks.
    outcomes = Scratch(spark).write(outcomes.select("change_id", "user_id", "outcome", "insert_failed"))
    after = audit.quarantine_merge(held, audit.quarantine_new(outcomes, spec), spec)
    return spec, log, outcomes, after


@query(with_(CYCLE, """
SELECT change_id, user_id, CASE WHEN change_id IN (SELECT change_id FROM marked) THEN 1 ELSE processed END
         AS processed FROM elog"""))
def mark_done(spark, sf_dir):
    spec, log, outcomes, after = _cycle(spark, sf_dir)
    stamped = audit.mark_done(log, audit.marks(outcomes, after, spec), spec)
    return stamped.select("change_id", "user_id", "processed")


@query(with_(CYCLE, """
SELECT change_id, user_id FROM elog
WHERE processed = 0 AND change_id NOT IN (SELECT change_id FROM marked)"""))
def still_pending(spark, sf_dir):
    spec, log, outcomes, after = _cycle(spark, sf_dir)
    stamped = audit.mark_done(log, audit.marks(outcomes, after, spec), spec)
    return queue_page(stamped, spec).select("change_id", "user_id")


@query(with_(CYCLE, """
SELECT change_id, user_id FROM elog
WHERE processed = 0 AND change_id NOT IN (SELECT change_id FROM marked)
  AND user_id NOT IN (SELECT user_id FROM done WHERE ifail)"""))
def requeue_query(spark, sf_dir):
    """Clearing the keys held from earlier makes their pending rows eligible again."""
    spec, log, outcomes, after = _cycle(spark, sf_dir)
    stamped = audit.mark_done(log, audit.marks(outcomes, after, spec), spec)
    cleared = audit.quarantine_clear(after, audit.quarantine_keys(_earlier_quarantine(log), spec), spec)
    return queue_page(stamped, spec, cleared).select("change_id", "user_id")


BATCHES = f"""{EVENT_ON},
numbered AS (SELECT *, (row_number() OVER (ORDER BY change_id) - 1) // {BATCH} + 1 AS batch FROM done),
batches AS (
  SELECT batch, count(*) AS rows_read, count(*) FILTER (WHERE outcome = 'INSERTED') AS inserted,
         count(*) FILTER (WHERE outcome = 'UPDATED') AS updated,
         count(*) FILTER (WHERE outcome = 'DELETED') AS deleted,
         count(*) FILTER (WHERE outcome = 'FAILED') AS failed, max(change_id) AS last_key
  FROM numbered GROUP BY batch)"""


@query(with_(BATCHES, "SELECT * FROM batches"))
def batch_counts(spark, sf_dir):
    spec = event_spec()
    return audit.batch_counts(replay(event_log(spark, sf_dir), spec), spec, BATCH)


@query(with_(BATCHES, """
SELECT batch, rows_read, CAST(sum(rows_read) OVER (ORDER BY batch) AS BIGINT) AS total, last_key FROM batches"""))
def batch_progress(spark, sf_dir):
    spec = event_spec()
    batches = audit.batch_counts(replay(event_log(spark, sf_dir), spec), spec, BATCH)
    return audit.batch_progress(batches, BATCH)


# -- scans -------------------------------------------------------------------------------

LOG_COLUMNS = "change_id, op AS operation, user_id, k, amount AS value, processed"
MIDDLE = "(SELECT max(change_id) // 2 FROM elog)"


def _middle(log):
    return log.agg((F.max("change_id") / 2).cast("long")).first()[0]


@query(with_(EVENT_LOG, f"SELECT {LOG_COLUMNS} FROM elog"))
def scan_changes_query(spark, sf_dir):
    return scan_changes(event_log(spark, sf_dir), event_spec())


@query(with_(EVENT_LOG, f"SELECT {LOG_COLUMNS} FROM elog ORDER BY change_id LIMIT {BATCH}"))
def keyset_first(spark, sf_dir):
    return keyset_page(event_log(spark, sf_dir), event_spec(), rows=BATCH)


PAGES = """
SELECT (row_number() OVER (ORDER BY change_id) - 1) // {0} + 1 AS page, change_id, user_id FROM elog {1}"""


def _paged(rows, pages):
    """Each row with the number of its page; one page after the other is read from ``pages``."""
    out = [page.select(F.lit(n).cast("long").alias("page"), "change_id", "user_id") for n, page in enumerate(pages, 1)]
    return reduce(DataFrame.unionByName, out, rows.limit(0).select(F.lit(0).cast("long").alias("page"), "change_id", "user_id"))


def _fifth(log) -> int:
    return (log.count() + 4) // 5


@query(with_(EVENT_LOG, PAGES.format("(SELECT (count(*) + 4) // 5 FROM elog)", "")))
def keyset_pages(spark, sf_dir):
    """The whole log in five pages, cut at borders that one pass finds."""
    log, pages, last = event_log(spark, sf_dir), [], None
    for border in page_borders(log, "change_id", _fifth(log)):
        pages.append(keyset_page(log, event_spec(), last).where(up_to("change_id", border)))
        last = border
    return _paged(log, pages)


@query(with_(EVENT_LOG, PAGES.format("(SELECT (count(*) + 4) // 5 FROM elog WHERE processed = 0)", "WHERE processed = 0")))
def queue_pages(spark, sf_dir):
    """All pending rows in five pages."""
    log, pages = event_log(spark, sf_dir), []
    waiting = queue_page(log, event_spec(processed_column="processed"))
    last = F.lit(None)
    for border in page_borders(waiting, "change_id", _fifth(waiting)):
        after = F.coalesce(F.col("change_id") > last, F.lit(True))
        pages.append(waiting.where(up_to("change_id", border) & after))
        last = border
    return _paged(log, pages)


@query(with_(EVENT_LOG, f"""
SELECT {LOG_COLUMNS} FROM elog WHERE change_id > {MIDDLE} ORDER BY change_id LIMIT {BATCH}"""))
def keyset_next(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return keyset_page(log, event_spec(), _middle(log), BATCH)


@query(with_(EVENT_LOG, f"SELECT {LOG_COLUMNS} FROM elog WHERE change_id <= {MIDDLE}"))
def late_changes_query(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return late_changes(log, event_spec(), _middle(log))


@query(with_(EVENT_LOG, f"""
SELECT {LOG_COLUMNS} FROM elog WHERE processed = 0 ORDER BY change_id LIMIT {BATCH}"""))
def queue_pending(spark, sf_dir):
    return queue_page(event_log(spark, sf_dir), event_spec(processed_column="processed"), rows=BATCH)


@query(with_(f"{EVENT_LOG}, held AS ({EARLIER})", f"""
SELECT {LOG_COLUMNS} FROM elog
WHERE processed = 0 AND user_id NOT IN (SELECT user_id FROM held) ORDER BY change_id LIMIT {BATCH}"""))
def queue_pending_clean(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return queue_page(log, event_spec(processed_column="processed"), _earlier_quarantine(log), BATCH)


@query(with_(EVENT_LOG, """
SELECT change_id, op AS operation, user_id FROM elog WHERE op = 'I'
UNION ALL SELECT change_id, op, user_id FROM elog WHERE op = 'U'
UNION ALL SELECT change_id, op, user_id FROM elog WHERE op = 'D'
UNION ALL SELECT change_id, op, user_id FROM elog WHERE op NOT IN ('I', 'U', 'D')"""))
def union_changes(spark, sf_dir):
    """Change rows appended from several selects; deletes and unknown ones carry only the key."""
    log = event_log(spark, sf_dir)
    inserts, updates = log.where("operation = 'I'"), log.where("operation = 'U'")
    others = log.where("coalesce(operation, '') not in ('I', 'U')").select("change_id", "operation", "user_id")
    whole = inserts.unionByName(updates).unionByName(others, allowMissingColumns=True)
    return whole.select("change_id", "operation", "user_id")


@query("""
WITH ids AS (SELECT o_orderkey AS order_id FROM orders),
top AS (SELECT max(order_id) + 1 AS step FROM ids),
ins AS (
  SELECT order_id, 'First' || order_id AS cust_first_name, 'Last' || order_id AS cust_last_name,
         strftime(DATE '2026-06-30' - CAST(order_id % 365 AS INTEGER), '%d') AS order_day,
         strftime(DATE '2026-06-30' - CAST(order_id % 365 AS INTEGER), '%m') AS order_month,
         strftime(DATE '2026-06-30' - CAST(order_id % 365 AS INTEGER), '%Y') AS order_year,
         CASE order_id % 4 WHEN 0 THEN 'NW' WHEN 1 THEN 'SH' WHEN 2 THEN 'DL' ELSE 'CN' END AS status_code,
         CASE order_id % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'AE' WHEN 3 THEN 'IN' ELSE 'ZZ' END
           AS country_code,
         (CAST('0x' || left(md5('1:' || order_id), 8) AS BIGINT) % 49901 + 100) / 100.0 AS unit_price,
         CAST(CAST('0x' || left(md5('2:' || order_id), 8) AS BIGINT) % 9 + 1 AS DOUBLE) AS quantity
  FROM ids)
SELECT order_id AS change_id, 'I' AS operation, order_id, cust_first_name, cust_last_name,
       order_day, order_month, order_year, status_code, country_code, unit_price, quantity FROM ins
UNION ALL
SELECT order_id + step, 'U', order_id, cust_first_name, cust_last_name,
       order_day, order_month, order_year, 'SH', country_code, unit_price, quantity FROM ins, top WHERE order_id % 10 = 0
UNION ALL
SELECT order_id + 2 * step, 'D', order_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM ins, top WHERE order_id % 100 = 0""")
def gen_changes(spark, sf_dir):
    """Bulk log over the ids of the orders table."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"))
    return generate_from(ids, ids.agg(F.max("order_id")).first()[0] + 1)


# -- updates and deletes of other shapes ---------------------------------------------------

# Generations end with the deletes that remove a row; a column has its own last writer.
SHAPED = """,
g1 AS (SELECT *, count(*) FILTER (WHERE {gone}) OVER (PARTITION BY user_id ORDER BY change_id) AS gen FROM done),
g2 AS (SELECT *, max(gen) OVER (PARTITION BY user_id) AS last_gen FROM g1)"""


@query(with_(EVENT_OFF + SHAPED.format(gone="outcome = 'DELETED'"), """
SELECT min(change_id) FILTER (WHERE outcome = 'INSERTED') AS profile_id, user_id,
       CAST(last(k ORDER BY change_id) FILTER (WHERE effective AND (op = 'I' OR k IS NOT NULL)) AS VARCHAR) AS k,
       last(CASE WHEN op = 'I' OR k % 2 = 0 THEN amount END ORDER BY change_id)
         FILTER (WHERE effective AND (op = 'I' OR k % 2 = 0 AND amount IS NOT NULL)) AS amount
FROM g2 WHERE gen = last_gen GROUP BY user_id HAVING count(*) FILTER (WHERE effective) > 0"""))
def keep_null_update(spark, sf_dir):
    """An update leaves a column alone where its expression gives null: here for every odd k."""
    columns = {"k": ":K", "amount": "if(:K % 2 = 0, :VALUE, null)"}
    update = Mapping(columns, {"k": "coalesce(:K, 99) >= 98"}, keep_null=("k", "amount"))
    spec = event_spec(quarantine=False, update=update)
    return text_key(apply_final(event_log(spark, sf_dir), spec), "k")


SOFT = EVENT_LOG + """,
s1 AS (
  SELECT *, coalesce(bool_or(op = 'I' AND reason IS NULL) OVER (PARTITION BY user_id ORDER BY change_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS present FROM elog),
s2 AS (
  SELECT *, CASE WHEN op NOT IN ('I', 'U', 'D') THEN 'SKIPPED_BADROW'
                 WHEN op = 'I' AND (reason IS NOT NULL OR present) THEN 'FAILED'
                 WHEN op = 'U' AND present AND reason IS NOT NULL THEN 'FAILED'
                 WHEN op = 'D' AND present AND k >= 90 THEN 'FAILED'
                 WHEN op = 'I' THEN 'INSERTED' WHEN op = 'D' THEN 'DELETED' ELSE 'UPDATED' END AS outcome
  FROM s1),
s3 AS (SELECT *, outcome = 'INSERTED' OR outcome IN ('UPDATED', 'DELETED') AND present AS effective FROM s2)"""


def _soft_spec():
    """A delete marks its row instead of removing it, and may itself be rejected."""
    return event_spec(quarantine=False, delete=Mapping({"k": "-1"}, {"k": ":K >= 90"}))


@query(with_(SOFT, """
SELECT min(change_id) FILTER (WHERE outcome = 'INSERTED') AS profile_id, user_id,
       CAST(last(CASE WHEN op = 'D' THEN -1 ELSE k END ORDER BY change_id) FILTER (WHERE effective) AS VARCHAR) AS k,
       last(amount ORDER BY change_id) FILTER (WHERE effective AND op <> 'D') AS amount
FROM s3 GROUP BY user_id HAVING count(*) FILTER (WHERE effective) > 0"""))
def soft_delete(spark, sf_dir):
    return text_key(apply_final(event_log(spark, sf_dir), _soft_spec()), "k")


@query(with_(SOFT, "SELECT change_id, user_id, outcome FROM s3"))
def soft_delete_outcomes(spark, sf_dir):
    return replay(event_log(spark, sf_dir), _soft_spec()).select("change_id", "user_id", "outcome")


# -- whole runs: stored state, commits, streaming ------------------------------------------


def _store(spark) -> Store:
    return Store(spark, f"{shared_dir(spark)}/tidemark/runs/{uuid.uuid4().hex}", buckets=8)


def _half(log) -> int:
    return (log.count() + 1) // 2


@query(with_(ORDER_IMAGE, f"SELECT row_id AS summary_id, order_id, {ORDER_VALUES} FROM img"))
def keyset_run_target(spark, sf_dir):
    """Target after two committed cycles."""
    store, log = _store(spark), order_log(spark, sf_dir)
    run_keyset(store, order_spec(), log, batch_size=_half(log))
    return store.read("target")


@query(with_(ORDER_IMAGE, f"SELECT row_id AS summary_id, order_id, {ORDER_VALUES} FROM img"))
def delta_run_target(spark, sf_dir):
    """Target after cycles of which the first writes base rows, the next ones changes, and the last one folds a bucket's."""
    store, log = _store(spark), order_log(spark, sf_dir)
    inserts = log.where("operation = 'I'").count()
    run_keyset(store, order_spec(), log, batch_size=inserts, max_cycles=1)
    run_keyset(store, order_spec(), log, batch_size=max(1, inserts // 16), max_cycles=2)
    # Updates of rows as they are: they outgrow the base, which is folded.
    again = log.where("operation = 'I' and order_id % 100 <> 0 and order_id % 10 <> 0")
    again = again.withColumns({"change_id": F.col("change_id") + 3 * 10**15, "operation": F.lit("U")})
    run_keyset(store, order_spec(), log.unionByName(again))
    return store.read("target")


@query(with_(ORDER_IMAGE, """
SELECT order_id, CASE WHEN changed THEN region END AS region, 1767323045000000 AS synced_at,
  1767323045000000 AS recorded_at
FROM (SELECT *, order_id % 10 = 0 AS changed FROM img)"""))
def added_column_run(spark, sf_dir):
    """A target column that the spec of the second run adds, null in rows that only the first run wrote; and the
    instant of both runs, in the target as in the history.
    """
    store, log = _store(spark), order_log(spark, sf_dir)
    spec, as_of = order_spec(stamped=True), datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    without = {n: m for n, m in spec.insert.columns.items() if n != "region"}
    target = {n: c if n != "region" else replace(c, nullable=True) for n, c in spec.target.items()}
    before = replace(spec, target={n: c for n, c in target.items() if n != "region"}, insert=Mapping(without), update=Mapping(without))
    run_keyset(store, before, log.where("operation = 'I'"), as_of=as_of)
    run_keyset(store, replace(spec, target=target), log, as_of=as_of)
    recorded = store.read("history").where("operation = 'I'").select("order_id", F.unix_micros(audit.RECORDED_AT).alias("recorded_at"))
    rows = store.read("target").select("order_id", "region", F.unix_micros("synced_at").alias("synced_at"))
    return rows.join(recorded, "order_id")


@query(with_(ORDER_IMAGE, """
SELECT row_id AS link_id, row_id AS summary_id, 'u-100' AS user_id, 'orders' AS user_section FROM img"""))
def keyset_run_links(spark, sf_dir):
    store, log = _store(spark), order_log(spark, sf_dir)
    run_keyset(store, order_spec(), log, batch_size=_half(log))
    return store.read("links")


@query(with_(EVENT_ON, HISTORY.format("done")))
def keyset_run_history(spark, sf_dir):
    """History and quarantine of a keyset run do not depend on where it is cut."""
    store, log = _store(spark), event_log(spark, sf_dir)
    run_keyset(store, event_spec(), log, batch_size=_half(log))
    return text_key(store.read("history").drop(audit.RECORDED_AT), "user_id")


FIFTHS = f"""{EVENT_ON},
numbered AS (SELECT *, (row_number() OVER (ORDER BY change_id) - 1) // (SELECT (count(*) + 4) // 5 FROM elog) + 1 AS cycle FROM done)"""


@query(with_(FIFTHS, """
SELECT cycle, count(*) AS rows_read, count(*) FILTER (WHERE outcome = 'INSERTED') AS inserted,
  count(*) FILTER (WHERE outcome = 'UPDATED') AS updated, count(*) FILTER (WHERE outcome = 'DELETED') AS deleted,
  count(*) FILTER (WHERE outcome = 'FAILED') AS failed, CAST(sum(count(*)) OVER (ORDER BY cycle) AS BIGINT) AS total,
  CAST(max(change_id) AS VARCHAR) AS last_key
FROM numbered GROUP BY cycle"""))
def paced_cycles(spark, sf_dir):
    """Cycles of a fifth of the log at most, two to a start, each start going on after the last: what each has reported."""
    store, log = _store(spark), event_log(spark, sf_dir)
    reports = []
    while some := run_keyset(store, event_spec(), log, batch_size=_fifth(log), max_cycles=2):
        reports += some
    counts = ("rows_read", "inserted", "updated", "deleted", "failed", "total")
    rows = [(r.version, *[getattr(r, c) for c in counts], r.last_key) for r in reports]
    return spark.createDataFrame(rows, f"cycle long, {', '.join(f'{c} long' for c in counts)}, last_key string")


@query(with_(EVENT_ON, HISTORY.format("done")))
def batch_applied_twice(spark, sf_dir):
    """A micro-batch that comes again after its commit changes nothing."""
    store, log = _store(spark), event_log(spark, sf_dir)
    for _ in range(2):
        apply_batch(store, event_spec(), log, "events:1", 0)
    return text_key(store.read("history").drop(audit.RECORDED_AT), "user_id")


SOME = f"""{ORDER_LOG},
page AS (SELECT * FROM elog WHERE NOT (op = 'I' AND order_id % 30 = 0)),
{replayed("", "order_id", quarantine=False, source="page", on_missing="upsert")},
{imaged("order_id", ORDER_NAMES)}"""


@query(with_(SOME, """
SELECT row_id AS link_id, row_id AS summary_id, 'u-100' AS user_id, 'orders' AS user_section
FROM img WHERE row_id IN (SELECT change_id FROM page WHERE op = 'I')"""))
def upsert_run_links(spark, sf_dir):
    """Rows that an update has made get no link."""
    store, log = _store(spark), order_log(spark, sf_dir)
    log = log.where("not (operation = 'I' and order_id % 30 = 0)")
    run_keyset(store, order_spec(quarantine=False, on_missing="upsert"), log, batch_size=_half(log))
    return store.read("links")


@query(with_(EVENT_LOG, f"SELECT change_id, user_id FROM elog WHERE change_id <= {MIDDLE}"))
def stream_late_rows(spark, sf_dir):
    """The upper half of the log comes first; what follows is late, and kept."""
    store, log, folder = _store(spark), event_log(spark, sf_dir), f"{shared_dir(spark)}/tidemark/runs/{uuid.uuid4().hex}"
    spec, late = event_spec(), F.col("change_id") <= _middle(log)
    for part in (log.where(~late), log.where(late)):
        part.write.mode("append").parquet(folder)
        stream = read_change_stream(spark, folder, log.schema)
        run_stream(store, spec, stream, f"{store.files.root}/checkpoint").awaitTermination()
    return store.read("late").select("change_id", "user_id")


TURNED = f"""{EVENT_LOG},
turned AS (SELECT * REPLACE (CASE WHEN change_id <= {MIDDLE} THEN change_id + 1000000000000000 ELSE change_id END AS change_id) FROM elog),
{replayed("", "user_id", quarantine=False, source="turned")},
late AS (SELECT * REPLACE (change_id % 1000000000000000 AS change_id) FROM done)"""


@query(with_(TURNED, HISTORY.format("late")))
def stream_late_applied(spark, sf_dir):
    """The upper half of the log comes first; by the rules of a queue the lower half is applied after it."""
    store, log, folder = _store(spark), event_log(spark, sf_dir), f"{shared_dir(spark)}/tidemark/runs/{uuid.uuid4().hex}"
    late = F.col("change_id") <= _middle(log)
    for part in (log.where(~late), log.where(late)):
        part.write.mode("append").parquet(folder)
        stream = read_change_stream(spark, folder, log.schema)
        run = run_stream(store, event_spec(quarantine=False), stream, f"{store.files.root}/checkpoint", late_rows="apply")
        run.awaitTermination()
    return text_key(store.read("history").drop(audit.RECORDED_AT), "user_id")


@query(with_(ORDER_IMAGE, f"SELECT row_id AS summary_id, order_id AS order_no, {ORDER_VALUES} FROM img"))
def renamed_key(spark, sf_dir):
    """The target calls the business key by a name of its own; two cycles, so that it is read back as well."""
    store, log = _store(spark), order_log(spark, sf_dir)
    run_keyset(store, order_spec(target_keys={"order_id": "order_no"}), log, batch_size=_half(log))
    return store.read("target")


# The whole log again, placed behind itself: what a restart over the finished state does.
AGAIN = f"""{EVENT_LOG},
twice AS (SELECT * FROM elog
          UNION ALL SELECT * REPLACE (change_id + 1000000000000000 AS change_id) FROM elog),
{replayed("", "user_id", source="twice")},
second AS (SELECT * REPLACE (change_id - 1000000000000000 AS change_id) FROM done
           WHERE change_id >= 1000000000000000)"""


@query(with_(AGAIN, HISTORY.format("second")))
def restart_run_history(spark, sf_dir):
    """A restart meets its own target and quarantine; each record shows the latest run."""
    store, log = _store(spark), event_log(spark, sf_dir)
    run_keyset(store, event_spec(), log)
    run_keyset(store, event_spec(), log, restart=True)
    return text_key(store.read("history").drop(audit.RECORDED_AT), "user_id")


QUEUE = f"""{EVENT_LOG},
page AS (SELECT * FROM elog WHERE processed = 0),
{replayed("", "user_id", source="page")},
held AS (SELECT DISTINCT user_id FROM done WHERE ifail)"""


@query(with_(QUEUE, """
SELECT change_id, user_id FROM page WHERE op <> 'X' AND user_id IN (SELECT user_id FROM held)"""))
def queue_run_pending(spark, sf_dir):
    """After a queue run, rows of quarantined keys wait; everything else is stamped."""
    store, log = _store(spark), event_log(spark, sf_dir)
    spec = event_spec(processed_column="processed")
    run_queue(store, spec, log)
    return pending(store, spec, log).select("change_id", "user_id")


# A queue takes the lower half of the log after the upper half, when it turns up late.
LATE = f"""{EVENT_LOG},
turned AS (SELECT * REPLACE (CASE WHEN change_id <= {MIDDLE} THEN change_id + 1000000000000000 ELSE change_id END AS change_id)
           FROM elog WHERE processed = 0),
{replayed("", "user_id", quarantine=False, source="turned")},
late AS (SELECT * REPLACE (change_id % 1000000000000000 AS change_id) FROM done)"""


@query(with_(LATE, HISTORY.format("late")))
def queue_late_run(spark, sf_dir):
    """Late rows with lower keys than those already stamped are read, and applied after them."""
    store, log = _store(spark), event_log(spark, sf_dir)
    spec = event_spec(processed_column="processed", quarantine=False)
    run_queue(store, spec, log.where(F.col("change_id") > _middle(log)))
    run_queue(store, spec, log)
    return text_key(store.read("history").drop(audit.RECORDED_AT), "user_id")


@query(with_(QUEUE, """
SELECT (SELECT count(*) FROM page WHERE op <> 'X' AND user_id IN (SELECT user_id FROM held WHERE user_id % 2 = 0)) AS replayed,
  (SELECT count(*) FROM held) AS held"""))
def requeue_second_run(spark, sf_dir):
    """All rows of cleared keys flow again in a second run; an insert of each fails once more, so that all are held again."""
    store, log = _store(spark), event_log(spark, sf_dir)
    spec = event_spec(processed_column="processed")
    run_queue(store, spec, log)
    requeue(store, spec, store.read("quarantine").where("user_id % 2 = 0"))
    read = sum(r.rows_read for r in run_queue(store, spec, log))
    return store.read("quarantine").agg(F.lit(read).cast("long").alias("replayed"), F.count("*").alias("held"))


@query(with_(QUEUE, "SELECT user_id FROM held WHERE user_id % 2 = 1"))
def requeue_run(spark, sf_dir):
    """Quarantine after a queue run and the clearing of the even keys."""
    store, log = _store(spark), event_log(spark, sf_dir)
    spec = event_spec(processed_column="processed")
    run_queue(store, spec, log)
    requeue(store, spec, store.read("quarantine").where("user_id % 2 = 0"))
    return store.read("quarantine").select("user_id")


@query(with_(EVENT_ON, HISTORY.format("done")))
def stream_run_history(spark, sf_dir):
    """The event table as a stream of change files: all that are there make one micro-batch."""
    store, schema = _store(spark), table(spark, sf_dir, "events").schema
    stream = read_change_stream(spark, f"{sf_dir}/events*.parquet", schema)
    run = run_stream(store, event_spec(), event_columns(stream), f"{store.files.root}/checkpoint")
    run.awaitTermination()
    return text_key(store.read("history").drop(audit.RECORDED_AT), "user_id")
