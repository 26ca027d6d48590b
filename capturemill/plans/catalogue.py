"""Registered queries over the driver tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturemill.functions.scalars import contains, make_date, parse_filename, second_boundaries, segment, strptime
from capturemill.operators import asof, captures, checks, diff, history, origin, spine
from capturemill.plans import builds, publish

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query with its SQL."""

    def keep(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark, sf_dir):
    return read(spark, sf_dir, "orders").withColumn("season", F.year("o_orderdate"))


def _events(spark, sf_dir):
    return read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))


def _price(c: str):
    return F.col(c).cast("decimal(18,2)")


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(spark, sf_dir):
    """The newest event of each user."""
    return captures.latest(read(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type", "value")


@query("SELECT year(o_orderdate)::INT AS season, o_orderkey, o_custkey FROM orders o WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders p WHERE year(p.o_orderdate) = year(o.o_orderdate))")
def latest_group_members(spark, sf_dir):
    """All orders of each year's newest order date."""
    return captures.latest_group(_orders(spark, sf_dir), ["season"], ["o_orderdate"]).select("season", "o_orderkey", "o_custkey")


@query("SELECT year(o_orderdate)::INT AS season, o_custkey, o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY year(o_orderdate), o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_attr_any_capture(spark, sf_dir):
    """Each customer's newest priority by year."""
    return captures.latest(_orders(spark, sf_dir), ["season", "o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("season", "o_custkey", "o_orderpriority", "o_orderkey")


@query("SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY (l_returnflag = 'R') DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1")
def preference_dedup(spark, sf_dir):
    """One line per order and number: returned first, then the newest."""
    order = [F.desc(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    return captures.prefer(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], F.col("l_returnflag") == "R", order).select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_partkey")


@query("""WITH e AS (SELECT *, ts::DATE AS day FROM events), n AS (SELECT user_id, max(day) AS day FROM e GROUP BY 1),
    k AS (SELECT DISTINCT e.user_id, e.event_type FROM e JOIN n USING (user_id, day))
    SELECT user_id, event_type, count(*) AS n FROM e SEMI JOIN k USING (user_id, event_type) GROUP BY ALL""")
def retraction(spark, sf_dir):
    """Events of types that the user's newest day still has."""
    return captures.retract(_events(spark, sf_dir), ["user_id"], ["user_id", "event_type"], ["day"]).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH m AS (SELECT user_id, max(ts) AS moment FROM events WHERE event_type = 'purchase' GROUP BY 1),
    j AS (SELECT e.*, moment, moment IS NULL OR ts < moment AS is_before FROM events e LEFT JOIN m USING (user_id))
    SELECT user_id, event_id, is_before FROM j QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY is_before DESC,
    CASE WHEN is_before THEN ts END DESC NULLS LAST, CASE WHEN is_before THEN event_id END DESC NULLS LAST, ts, event_id) = 1""")
def pre_moment_else_earliest(spark, sf_dir):
    """The last event before the user's last purchase, else the earliest."""
    e = read(spark, sf_dir, "events")
    m = e.filter("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("moment"))
    return captures.before_moment_else_earliest(e.join(m, "user_id", "left"), ["user_id"], "ts", "event_id", "moment").select("user_id", "event_id", "is_before")


def _scd2_sql(fields: list[str]) -> str:
    row = ", ".join(fields)
    return f"""WITH c AS (SELECT year(o_orderdate)::INT AS season, *, row_number() OVER w AS n, lag(struct_pack({', '.join(f'{f} := {f}' for f in fields)})) OVER w AS prev FROM orders WINDOW w AS (PARTITION BY year(o_orderdate), o_custkey ORDER BY o_orderdate, o_orderkey)),
    o AS (SELECT * FROM c WHERE n = 1 OR struct_pack({', '.join(f'{f} := {f}' for f in fields)}) IS DISTINCT FROM prev)
    SELECT season, o_custkey, o_orderdate AS valid_from, lead(o_orderdate) OVER (PARTITION BY season, o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to, {row}, o_orderkey FROM o"""


@query(_scd2_sql(["o_orderpriority"]))
def scd2_history(spark, sf_dir):
    """History of each customer's priority within a year."""
    return history.scd2(_orders(spark, sf_dir), ["season", "o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderpriority"], ["o_orderkey"])


@query(_scd2_sql(["o_orderpriority", "o_orderstatus"]))
def scd2_multi_field(spark, sf_dir):
    """History of priority and status together."""
    return history.scd2(_orders(spark, sf_dir), ["season", "o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderpriority", "o_orderstatus"], ["o_orderkey"])


@query(f"""WITH h AS ({_scd2_sql(["o_orderpriority"])}), r AS (SELECT DISTINCT year(l_shipdate)::INT AS season, o_custkey, l_shipdate FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT r.season, r.o_custkey, r.l_shipdate, h.o_orderpriority, h.valid_from FROM r JOIN h ON h.season = r.season AND h.o_custkey = r.o_custkey AND h.valid_from < r.l_shipdate AND (h.valid_to IS NULL OR r.l_shipdate <= h.valid_to)""")
def scd2_interval_join(spark, sf_dir):
    """The priority in force at each ship date."""
    h = history.scd2(_orders(spark, sf_dir), ["season", "o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderpriority"])
    l = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    r = l.select(F.year("l_shipdate").alias("season"), "o_custkey", "l_shipdate").distinct()
    return history.in_force(r, h, ["season", "o_custkey"], "l_shipdate", "inner").select("season", "o_custkey", "l_shipdate", "o_orderpriority", "valid_from")


_ASOF = """SELECT r.event_id, r.user_id, p.event_id AS purchase_id, p.value AS purchase_value FROM (SELECT * FROM events WHERE event_type = 'error') r
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON r.user_id = p.user_id AND p.ts < r.ts"""


def _purchases(e):
    return e.filter("event_type = 'purchase'").select("user_id", "ts", "day", F.col("event_id").alias("purchase_id"), F.col("value").alias("purchase_value"))


@query(_ASOF)
def asof_strict(spark, sf_dir):
    """Each error with the user's last purchase before it."""
    e = _events(spark, sf_dir)
    r = e.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    return asof.as_of(r, _purchases(e), "ts", "ts", ["user_id"], ["purchase_id", "purchase_value"]).drop("ts")


@query(_ASOF)
def asof_small_relation(spark, sf_dir):
    """The same by a range join and a greatest time per request."""
    e = _events(spark, sf_dir)
    r = e.filter("event_type = 'error'").select("event_id", "user_id", F.col("ts").alias("at"))
    return asof.as_of_small(r, _purchases(e), "at", "ts", ["user_id"], ["purchase_id", "purchase_value"], ["event_id"]).drop("at")


@query("""SELECT r.event_id, CASE WHEN p.ts >= r.ts - INTERVAL 24 HOUR THEN p.event_id END AS purchase_id FROM (SELECT * FROM events WHERE event_type = 'error') r
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON r.user_id = p.user_id AND p.ts < r.ts""")
def asof_max_age(spark, sf_dir):
    """The last purchase, if not older than a day."""
    e = _events(spark, sf_dir)
    r = e.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    return asof.as_of(r, _purchases(e), "ts", "ts", ["user_id"], ["purchase_id"], F.expr("INTERVAL 24 HOURS")).select("event_id", "purchase_id")


@query("""SELECT r.event_id, p.event_id AS purchase_id FROM (SELECT *, ts::DATE AS day FROM events WHERE event_type = 'error') r
    ASOF LEFT JOIN (SELECT *, ts::DATE AS day FROM events WHERE event_type = 'purchase') p ON r.day = p.day AND p.ts < r.ts""")
def asof_season_only_key(spark, sf_dir):
    """The last purchase of anyone on the day."""
    e = _events(spark, sf_dir)
    r = e.filter("event_type = 'error'").select("event_id", "day", "ts")
    return asof.as_of(r, _purchases(e), "ts", "ts", ["day"], ["purchase_id"], least=0).select("event_id", "purchase_id")


@query("""SELECT r.event_id, date_diff('second', p.ts, r.ts)::BIGINT AS age_seconds FROM (SELECT * FROM events WHERE event_type = 'error') r
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON r.user_id = p.user_id AND p.ts < r.ts""")
def state_age_seconds(spark, sf_dir):
    """Seconds from the last purchase to the error."""
    e = _events(spark, sf_dir)
    r = e.filter("event_type = 'error'").select("event_id", "user_id", F.col("ts").alias("at"))
    found = asof.as_of(r, _purchases(e).withColumn("bought", F.col("ts")), "at", "ts", ["user_id"], ["bought"])
    return found.select("event_id", second_boundaries(F.col("bought"), F.col("at")).alias("age_seconds"))


@query("""WITH c AS (SELECT max(ts) AS clock FROM events), d AS (SELECT user_id, max(ts) + INTERVAL 6 HOUR AS deadline FROM events GROUP BY 1)
    SELECT user_id, CASE WHEN deadline < clock THEN deadline END AS passed_deadline FROM d, c""")
def capture_clock_gate(spark, sf_dir):
    """A deadline shows only once the newest capture has passed it."""
    e = read(spark, sf_dir, "events")
    d = e.groupBy("user_id").agg((F.max("ts") + F.expr("INTERVAL 6 HOURS")).alias("deadline"))
    clock = d.agg((F.max("deadline") - F.expr("INTERVAL 6 HOURS")).alias("clock"))
    return d.crossJoin(F.broadcast(clock)).select("user_id", F.when(F.col("deadline") < F.col("clock"), F.col("deadline")).alias("passed_deadline"))


_SPINE = "WITH s AS (SELECT c_custkey, season FROM customer, (SELECT DISTINCT year(o_orderdate)::INT AS season FROM orders))"


def _grid(spark, sf_dir):
    years = _orders(spark, sf_dir).select("season").distinct().withColumn("one", F.lit(1))
    return spine.spine(read(spark, sf_dir, "customer").select("c_custkey", F.lit(1).alias("one")), years, ["one"]).drop("one")


@query(_SPINE + " SELECT * FROM s")
def spine_cross(spark, sf_dir):
    """Every customer in every year."""
    return _grid(spark, sf_dir)


@query(_SPINE + """ SELECT s.c_custkey, s.season, count(o_orderkey)::INT AS n_facts, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total,
    max_by(o_orderpriority, struct_pack(a := o_orderdate, b := o_orderkey)) AS priority, bool_and(o_orderstatus = 'F') AS all_final
    FROM s LEFT JOIN orders ON o_custkey = c_custkey AND year(o_orderdate) = season GROUP BY ALL""")
def spine_left_agg(spark, sf_dir):
    """Sums that stay null, last values and flags over the complete grid."""
    f = _orders(spark, sf_dir).withColumnRenamed("o_custkey", "c_custkey")
    out = spine.fill_spine(_grid(spark, sf_dir), f, ["c_custkey", "season"], "o_orderkey", {"total": _price("o_totalprice")}, {"priority": F.col("o_orderpriority")}, ["o_orderdate", "o_orderkey"], {"all_final": F.col("o_orderstatus") == "F"})
    return out.withColumn("total", F.col("total").cast("double"))


@query("""SELECT o_custkey, year(o_orderdate)::INT AS season, max_by(o_totalprice, struct_pack(a := o_orderdate, b := o_orderkey)) AS last_price FROM orders GROUP BY ALL""")
def point_in_time_max_by(spark, sf_dir):
    """The last order's price by customer and year."""
    return _orders(spark, sf_dir).groupBy("o_custkey", "season").agg(F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("last_price"))


@query(f"""WITH h AS ({_scd2_sql(["o_orderpriority"])}), m AS (SELECT season, make_timestamp(season, 7, 1, 0, 0, 0.0) AS moment FROM (SELECT DISTINCT season FROM h)),
    known AS (SELECT m.season, h.o_custkey, h.o_orderpriority FROM m JOIN h ON h.season = m.season AND h.valid_from < m.moment QUALIFY row_number() OVER (PARTITION BY m.season, h.o_custkey ORDER BY h.valid_from DESC, h.o_orderkey DESC) = 1),
    n AS (SELECT season, o_orderpriority, count(*) AS n FROM known GROUP BY ALL)
    SELECT known.season, known.o_custkey, known.o_orderpriority, n.n::INT AS n_at_moment FROM known JOIN n USING (season, o_orderpriority)""")
def fixture_count_at_moment(spark, sf_dir):
    """How many customers had a customer's priority at mid-year, as known then."""
    h = history.scd2(_orders(spark, sf_dir), ["season", "o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderpriority"]).withColumn("half", F.lit(1))
    r = h.select("season", "o_custkey", "half").distinct().withColumn("moment", F.make_timestamp_ntz(F.col("season"), F.lit(7), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    out = spine.count_at_moment(r, h, h.withColumn("side", F.col("o_orderpriority")), "season", "moment", "o_custkey", "o_orderpriority", "half", ["side"])
    return out.filter("n_at_moment is not null").select("season", "o_custkey", "o_orderpriority", "n_at_moment")


_PLAN = """WITH c AS (SELECT year(l_shipdate)::INT AS season, l_suppkey AS item, l_shipdate AS seen, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber END AS period, l_suppkey % 10 AS home,
        CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_partkey % 10 END AS away, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_returnflag FROM lineitem),
    o AS (SELECT * FROM c WINDOW w AS (PARTITION BY season, item ORDER BY seen, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_returnflag) QUALIFY lag(struct_pack(p := period, h := home, a := away)) OVER w IS DISTINCT FROM struct_pack(p := period, h := home, a := away)),
    h AS (SELECT season, item, seen AS valid_from, lead(seen) OVER (PARTITION BY season, item ORDER BY seen, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_returnflag) AS valid_to, period, home, away FROM o),
    g AS (SELECT season, o_custkey, side, valid_from FROM (SELECT year(o_orderdate)::INT AS season, o_custkey, o_orderkey % 12 AS side, o_orderdate AS valid_from, o_orderkey FROM orders) QUALIFY row_number() OVER (PARTITION BY season, o_custkey, valid_from ORDER BY o_orderkey DESC) = 1),
    m AS (SELECT season, period, make_timestamp(season, period + 3, 15, 0, 0, 0.0) AS moment FROM (SELECT DISTINCT season FROM h), (SELECT unnest(range(1, 9))::INT AS period)),
    r AS (SELECT m.*, k.o_custkey FROM m JOIN (SELECT DISTINCT season, o_custkey FROM g) k USING (season) JOIN (SELECT season, min(valid_from) AS first FROM h GROUP BY 1) z ON z.season = m.season AND z.first < m.moment),
    n AS (SELECT m.season, m.period, x.side, count(*) AS n FROM m JOIN (SELECT season, period, valid_from, valid_to, unnest([home, away]) AS side FROM h) x ON x.season = m.season AND x.period = m.period AND x.valid_from < m.moment AND (x.valid_to IS NULL OR x.valid_to >= m.moment) WHERE x.side IS NOT NULL GROUP BY ALL)
    SELECT r.season, r.o_custkey, r.period, g.side, CASE WHEN g.side IS NOT NULL THEN coalesce(n.n, 0) END::INT AS n_at_moment FROM r ASOF LEFT JOIN g ON g.season = r.season AND g.o_custkey = r.o_custkey AND g.valid_from < r.moment LEFT JOIN n ON n.season = r.season AND n.period = r.period AND n.side = g.side"""


@query(_PLAN)
def schedule_count_two_sides(spark, sf_dir):
    """How many items of each period a customer's side had in the middle of it, as then planned; zeros, unknown sides and items without a period or a second side among them."""
    l = read(spark, sf_dir, "lineitem")
    c = l.select(F.year("l_shipdate").alias("season"), F.col("l_suppkey").alias("item"), "l_shipdate", F.when(F.col("l_returnflag") != "R", F.col("l_linenumber")).alias("period"), (F.col("l_suppkey") % 10).alias("home"),
                 F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey") % 10).alias("away"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag")
    plan = history.scd2(c, ["season", "item"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag"], ["period", "home", "away"])
    sides = history.scd2(_orders(spark, sf_dir).withColumn("side", F.col("o_orderkey") % 12), ["season", "o_custkey"], ["o_orderdate", "o_orderkey"], ["side"])
    periods = plan.select("season").distinct().withColumn("period", F.explode(F.sequence(F.lit(1), F.lit(8)))).withColumn("moment", F.make_timestamp_ntz(F.col("season"), F.col("period") + 3, F.lit(15), F.lit(0), F.lit(0), F.lit(0)))
    r = spine.spine(sides.select("season", "o_custkey"), periods, ["season"])
    return spine.count_at_moment(r, sides, plan, "season", "moment", "o_custkey", "side", "period", ["home", "away"]).select("season", "o_custkey", "period", "side", "n_at_moment")


@query("SELECT user_id, coalesce(bool_or(a), false) AS any_good FROM (SELECT user_id, ts::DATE AS d, bool_and(value > 20) AS a FROM events GROUP BY ALL) GROUP BY ALL")
def two_level_bool_rollup(spark, sf_dir):
    """Users with a day on which all values are above 20."""
    return captures.all_then_any(_events(spark, sf_dir), ["user_id"], ["day"], F.col("value") > 20, "any_good")


_ADMIT = """SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'unknown' WHEN n_name IS NULL THEN 'no_nation' WHEN c_acctbal < 0 THEN 'negative' WHEN o_orderstatus IS DISTINCT FROM 'F' AND o_orderpriority LIKE '1%' THEN 'open_urgent' END AS reason
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"""


def _admitted(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    j = read(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    cascade = [("unknown", F.col("c_custkey").isNull()), ("no_nation", F.col("n_name").isNull()), ("negative", F.col("c_acctbal") < 0), ("open_urgent", ~F.col("o_orderstatus").eqNullSafe("F") & F.col("o_orderpriority").startswith("1"))]
    return j.select("o_orderkey", captures.first_reason(cascade).alias("reason"))


@query(_ADMIT)
def admission_cascade(spark, sf_dir):
    """The first reason not to admit an order."""
    return _admitted(spark, sf_dir)


@query(f"SELECT reason, reason IS NULL AS admitted, count(*) AS n FROM ({_ADMIT}) GROUP BY ALL")
def admission_reason_counts(spark, sf_dir):
    """Orders by reason."""
    return _admitted(spark, sf_dir).groupBy("reason", F.col("reason").isNull().alias("admitted")).agg(F.count(F.lit(1)).alias("n"))


@query(_SPINE + """, j AS (SELECT o_custkey, min(year(o_orderdate)) + 1 AS joined FROM orders GROUP BY 1), c AS (SELECT o_custkey, year(o_orderdate) AS season, max(o_orderkey) AS capture FROM orders GROUP BY ALL),
    g AS (SELECT s.c_custkey, s.season, joined, capture, CASE WHEN joined IS NULL OR s.season < joined THEN 'not_yet_joined' WHEN capture IS NOT NULL THEN 'captured' ELSE 'missing_after_join' END AS status
    FROM s LEFT JOIN j ON j.o_custkey = s.c_custkey LEFT JOIN c ON c.o_custkey = s.c_custkey AND c.season = s.season)
    SELECT c_custkey, season, status, CASE WHEN status = 'captured' THEN capture END AS capture FROM g""")
def grid_status(spark, sf_dir):
    """Customers by year: not yet joined, captured or missing."""
    o = _orders(spark, sf_dir).withColumnRenamed("o_custkey", "c_custkey")
    panel = read(spark, sf_dir, "customer").select("c_custkey", F.lit(1).alias("one")).join(o.groupBy("c_custkey").agg((F.min("season") + 1).alias("joined")), "c_custkey", "left")
    periods = o.select("season").distinct().withColumn("one", F.lit(1))
    seen = o.groupBy("c_custkey", "season").agg(F.max("o_orderkey").alias("capture"))
    return spine.grid_status(panel, periods, seen, ["one"], ["c_custkey"], "season", "joined", "capture").select("c_custkey", "season", "status", "capture")


@query("SELECT c_custkey, min(year(o_orderdate))::INT AS joined FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def join_week_min(spark, sf_dir):
    """The first year with an order."""
    first = _orders(spark, sf_dir).groupBy("o_custkey").agg(F.min("season").alias("joined"))
    return read(spark, sf_dir, "customer").join(first, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "joined")


@query("""SELECT o_orderkey, sum(l_quantity::DECIMAL(18,2) * coalesce(l_extendedprice, 0)::DECIMAL(18,2))::DOUBLE AS rebuilt, any_value(o_totalprice) AS published, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def weighted_sum_reconcile(spark, sf_dir):
    """A rebuilt total beside the published one. Lines are summed before they meet their order."""
    l = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(_price("l_quantity") * F.coalesce(_price("l_extendedprice"), F.lit(0))).cast("double").alias("rebuilt"), F.count(F.lit(1)).alias("n"))
    return l.join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "rebuilt", F.col("o_totalprice").alias("published"), "n")


@query("SELECT l_orderkey, l_linenumber::BIGINT * 10 AS slot, l_quantity::INT AS quantity FROM lineitem")
def explode_transform(spark, sf_dir):
    """Lines nested in arrays, transformed and exploded again."""
    n = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("lines"))
    x = F.transform("lines", lambda v: F.struct((v["l_linenumber"].cast("long") * 10).alias("slot"), v["l_quantity"].cast("int").alias("quantity")))
    return n.select("l_orderkey", F.inline(x))


@query("SELECT l_orderkey, list_contains(list(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber END), 3) AS has_three FROM lineitem GROUP BY 1")
def array_membership(spark, sf_dir):
    """Membership in an array that may hold nulls."""
    kept = F.collect_list(F.struct(F.when(F.col("l_returnflag") != "R", F.col("l_linenumber")).alias("v")))
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(kept, lambda s: s["v"]).alias("a")).select("l_orderkey", contains(F.col("a"), F.lit(3)).alias("has_three"))


@query("SELECT key, count(*) AS n FROM (SELECT unnest([l_partkey, l_suppkey]) AS key FROM lineitem) GROUP BY 1")
def unnest_pair(spark, sf_dir):
    """Both ends of each line, counted."""
    return read(spark, sf_dir, "lineitem").select(F.explode(F.array("l_partkey", "l_suppkey")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, (props->>'$.k')::INT AS k FROM events")
def json_extract_cast(spark, sf_dir):
    """A typed field of a JSON column by a declared schema."""
    return read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("SELECT key, count(*) AS records, count(*) FILTER (WHERE NOT coalesce(list_contains(json_keys(props), key), false)) AS missing FROM events, (VALUES ('k'), ('gone')) t(key) GROUP BY 1")
def json_key_presence(spark, sf_dir):
    """Records without a declared key."""
    return checks.key_presence(read(spark, sf_dir, "events"), "props", ["k", "gone"])


@query("SELECT page_id, split_part(url, '/', 3) AS host, regexp_extract(url, '/([a-z]{2})/', 1) AS lang FROM pages")
def key_from_path(spark, sf_dir):
    """Segments of a path."""
    return read(spark, sf_dir, "pages").select("page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), F.regexp_extract("url", "/([a-z]{2})/", 1).alias("lang"))


@query("SELECT event_id FROM events r WHERE event_type = 'error' AND EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = r.user_id AND p.ts < r.ts)")
def semi_exists_range(spark, sf_dir):
    """Errors after some purchase of the user: a range test against each user's first."""
    e = read(spark, sf_dir, "events")
    first = e.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("first"))
    return e.filter("event_type = 'error'").join(first, "user_id").filter("first < ts").select("event_id")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_not_exists(spark, sf_dir):
    """Orders without lines."""
    return read(spark, sf_dir, "orders").join(read(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("o_orderkey")


@query("""SELECT m.event_id FROM events m WHERE event_type = 'purchase' AND NOT EXISTS (SELECT 1 FROM events c WHERE c.event_type = 'view' AND c.user_id = m.user_id AND c.ts < m.ts AND c.ts >= m.ts - INTERVAL 125 MINUTE)""")
def missed_windows(spark, sf_dir):
    """Purchases without a view in the 125 minutes before."""
    e = read(spark, sf_dir, "events")
    m = e.filter("event_type = 'purchase'").select("event_id", "user_id", F.col("ts").alias("moment"))
    return checks.missed_windows(m, e.filter("event_type = 'view'").select("user_id", "ts"), ["user_id"], "moment", "ts", 125, F.lit("9999-01-01").cast("timestamp_ntz")).select("event_id")


_SLICES = "WITH a AS (SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'O')"


def _slices(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    cols = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    return o.filter("o_orderstatus <> 'P'").select(*cols), o.filter("o_orderstatus <> 'O'").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 10 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).select(*cols)


@query(_SLICES + """ SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'left_only' WHEN a.o_orderkey IS NULL THEN 'right_only' ELSE 'conflict' END AS status,
    CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN concat_ws(',', CASE WHEN a.o_totalprice IS DISTINCT FROM b.o_totalprice THEN 'o_totalprice' END, CASE WHEN a.o_orderpriority IS DISTINCT FROM b.o_orderpriority THEN 'o_orderpriority' END) END AS columns
    FROM a FULL JOIN b USING (o_orderkey) WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_totalprice IS DISTINCT FROM b.o_totalprice OR a.o_orderpriority IS DISTINCT FROM b.o_orderpriority""")
def full_outer_diff(spark, sf_dir):
    """Keys that differ between two builds."""
    return diff.key_diff(*_slices(spark, sf_dir), ["o_orderkey"])


@query(_SLICES + " SELECT *, 'left' AS side, 1::BIGINT AS surplus FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right', 1 FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def except_all_diff(spark, sf_dir):
    """Rows that differ between two builds, copies counted."""
    return diff.row_diff(*_slices(spark, sf_dir)).select("o_orderkey", "o_totalprice", "o_orderpriority", "side", F.col("surplus").cast("long").alias("surplus"))


@query("SELECT l_suppkey AS key FROM lineitem UNION SELECT ps FROM (SELECT s_suppkey AS ps FROM supplier)")
def union_distinct(spark, sf_dir):
    """Keys of either table once."""
    return read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("key")).union(read(spark, sf_dir, "supplier").select("s_suppkey")).distinct()




@query(f"""WITH n AS (SELECT user_id, max(ts) AS newest FROM events GROUP BY 1), c AS (SELECT max(ts) AS clock FROM events)
    SELECT user_id AS endpoint, CASE WHEN user_id % 50 = 0 THEN 'exempt' WHEN epoch_us(clock) - epoch_us(newest) > 18::BIGINT * 3600000000 THEN 'error' WHEN epoch_us(clock) - epoch_us(newest) > 6::BIGINT * 3600000000 THEN 'warn' ELSE 'ok' END AS status FROM n, c""")
def freshness_status(spark, sf_dir):
    """How old each user's newest event is by the capture clock."""
    e = read(spark, sf_dir, "events")
    users = e.select(F.col("user_id").alias("endpoint")).distinct().withColumn("exempt", F.col("endpoint") % 50 == 0)
    clock = e.agg(F.max("ts")).first()[0]
    got = e.select(F.col("user_id").alias("endpoint"), F.col("ts").alias("received_at"))
    return checks.freshness(users, got, F.lit(clock).cast("timestamp_ntz")).select("endpoint", "status")


@query("SELECT o_orderkey FROM orders WHERE o_totalprice < 2000 OR o_totalprice > 450000")
def value_between(spark, sf_dir):
    """Orders out of bounds."""
    return checks.value_between(read(spark, sf_dir, "orders"), "o_totalprice", 2000, 450000).select("o_orderkey")


@query("SELECT o_custkey, count(DISTINCT o_orderstatus) AS n_values, count(*) FILTER (WHERE o_orderstatus IS NULL) AS n_nulls, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS found FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1 OR n_nulls > 0")
def constant_per_key(spark, sf_dir):
    """Customers with orders of several states."""
    return checks.constant_per_key(read(spark, sf_dir, "orders"), "o_orderstatus", ["o_custkey"])


@query("SELECT o_orderkey, 'late' AS violating FROM (SELECT *, CASE WHEN o_totalprice > 300000 THEN NULL ELSE 1 END AS late FROM orders) WHERE (late IS NULL) <> (o_orderpriority = '1-URGENT')")
def null_exactly_when(spark, sf_dir):
    """Rows whose nullness doesn't follow the condition."""
    o = read(spark, sf_dir, "orders").withColumn("late", F.when(F.col("o_totalprice") <= 300000, 1))
    return checks.null_exactly_when(o, F.col("o_orderpriority") == "1-URGENT", ["late"]).select("o_orderkey", "violating")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 2)")
def relationships(spark, sf_dir):
    """Lines whose part isn't among the larger ones."""
    return checks.relationships(read(spark, sf_dir, "lineitem"), "l_partkey", read(spark, sf_dir, "part").filter("p_size > 2"), "p_partkey").select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, (o_orderkey % 5)::BIGINT AS declared, n AS n_rows FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE (o_orderkey % 5)::BIGINT IS DISTINCT FROM n")
def history_mismatch(spark, sf_dir):
    """Orders whose declared number of lines isn't that of the rows."""
    d = read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 5).alias("declared"))
    return checks.count_mismatch(d, read(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "declared")


@query("WITH d AS (SELECT event_type, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL) SELECT * FROM (SELECT *, lag(n) OVER (PARTITION BY event_type ORDER BY day) AS before FROM d) WHERE n < before")
def set_never_shrinks(spark, sf_dir):
    """Days with fewer events of a type than the day before."""
    return checks.never_shrinks(_events(spark, sf_dir).groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("n")), ["event_type"], "day", "n")


@query(f"""WITH h AS (SELECT * FROM ({_scd2_sql(["o_orderpriority"])}) WHERE o_orderkey % 3 <> 0), x AS (SELECT *, lead(valid_from) OVER (PARTITION BY season, o_custkey ORDER BY valid_from, valid_to NULLS LAST) AS nx FROM h)
    SELECT season, o_custkey, count(*) FILTER (WHERE valid_to IS DISTINCT FROM nx) AS n_breaks, count(*) FILTER (WHERE valid_to IS NULL) AS n_open FROM x GROUP BY ALL HAVING n_breaks > 0 OR n_open <> 1""")
def interval_contiguity(spark, sf_dir):
    """Histories that a loss of rows has broken."""
    h = history.scd2(_orders(spark, sf_dir), ["season", "o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderpriority"], ["o_orderkey"])
    return checks.broken_intervals(h.filter("o_orderkey % 3 <> 0"), ["season", "o_custkey"])


@query("""SELECT year(o_orderdate)::INT AS season, count(*) AS actual, (count(*) FILTER (WHERE o_orderstatus <> 'P') + 400)::BIGINT AS expected, count(*) >= floor((count(*) FILTER (WHERE o_orderstatus <> 'P') + 400) * 0.95) AS ok FROM orders GROUP BY 1""")
def per_season_floor(spark, sf_dir):
    """Counts by year against an expectation with 5 % tolerance."""
    g = _orders(spark, sf_dir).groupBy("season").agg(F.count(F.lit(1)).alias("actual"), (F.count_if(F.col("o_orderstatus") != "P") + 400).alias("expected"))
    return g.withColumn("ok", F.col("actual") >= F.floor(F.col("expected") * F.lit(0.95)))


_BY_SEASON = """SELECT 'orders' AS table_name, year(o_orderdate)::VARCHAR AS season, count(*) AS n FROM orders WHERE {0} GROUP BY 2 UNION ALL SELECT 'lineitem', year(l_shipdate)::VARCHAR, count(*) FROM lineitem WHERE {1} GROUP BY 2"""
_NOW = _BY_SEASON.format("year(o_orderdate) NOT IN (1995, 1996) OR o_orderkey % 10 <> 7", "year(l_shipdate) <> 1997")


def _rows_by_season(spark, sf_dir, whole: bool, name: str):
    """Rows of two tables by year, whole or with losses in three years."""
    o, l = _orders(spark, sf_dir), read(spark, sf_dir, "lineitem").withColumn("season", F.year("l_shipdate"))
    if not whole:
        o, l = o.filter(~F.col("season").isin(1995, 1996) | (F.col("o_orderkey") % 10 != 7)), l.filter("season <> 1997")
    return builds.build_shape({"orders": o, "lineitem": l}).withColumnRenamed("n_rows", name)


@query(f"""WITH a AS ({_NOW}), e AS ({_BY_SEASON.format("true", "true")}) SELECT table_name, season, coalesce(a.n, 0)::BIGINT AS n_rows, e.n AS expected, floor(e.n * 0.98::DOUBLE)::BIGINT AS floor FROM e LEFT JOIN a USING (table_name, season) WHERE coalesce(a.n, 0) < floor(e.n * 0.98::DOUBLE)""")
def publish_floor_failures(spark, sf_dir):
    """Seasons of tables that a publish would refuse: fewer rows than expected less the tolerance, or none."""
    return publish.floors(_rows_by_season(spark, sf_dir, False, "n_rows"), _rows_by_season(spark, sf_dir, True, "expected"), 0.02)


@query(f"""WITH a AS ({_NOW}), b AS ({_BY_SEASON.format("true", "true")}) SELECT table_name, season, coalesce(a.n, 0)::BIGINT AS n_rows, b.n AS n_before FROM b LEFT JOIN a USING (table_name, season) WHERE coalesce(a.n, 0) < b.n AND season <> '1996'""")
def publish_falling_counts(spark, sf_dir):
    """Seasons of tables with fewer rows than in the publish before, but for one that is restated."""
    return publish.falls(_rows_by_season(spark, sf_dir, False, "n_rows"), _rows_by_season(spark, sf_dir, True, "n_rows"), ["1996"])


@query("SELECT o_custkey, year(o_orderdate)::INT AS season, count(*) AS n_rows FROM orders GROUP BY ALL HAVING count(*) > 1")
def unique_combination(spark, sf_dir):
    """Customers with several orders in a year."""
    return checks.unique(_orders(spark, sf_dir), ["o_custkey", "season"])


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
def accepted_values(spark, sf_dir):
    """Orders of other priorities."""
    return checks.accepted_values(read(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"]).select("o_orderkey", "o_orderpriority")


@query("SELECT event_id FROM events WHERE event_type = 'error' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 90 UNION SELECT user_id FROM events WHERE event_type = 'view' AND value > 95)")
def unstaged_gap(spark, sf_dir):
    """Errors of users that neither staged relation has."""
    e = read(spark, sf_dir, "events")
    return checks.unstaged(e.filter("event_type = 'error'"), [e.filter("event_type = 'purchase' and value > 90"), e.filter("event_type = 'view' and value > 95")], "user_id").select("event_id")


@query("""WITH a AS (SELECT year(o_orderdate)::INT AS season, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 101 <> 0), b AS (SELECT year(o_orderdate)::INT AS season, o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders)
    SELECT season, (SELECT count(*) FROM a WHERE a.season = s.season) AS before_rows, (SELECT count(*) FROM b WHERE b.season = s.season) AS after_rows,
        (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b) x WHERE x.season = s.season) AS only_before, (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a) x WHERE x.season = s.season) AS only_after FROM (SELECT DISTINCT season FROM b) s""")
def build_diff_by_season(spark, sf_dir):
    """Rows by year of two builds of the orders, and what one of them alone has."""
    b = _orders(spark, sf_dir).select("season", "o_orderkey", F.when(F.col("o_orderkey") % 97 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    a = _orders(spark, sf_dir).filter("o_orderkey % 101 <> 0").select("season", "o_orderkey", "o_orderstatus")
    return builds.season_counts(a, b)


@query("""WITH n AS (SELECT r.event_id, count(*) AS n, min(a.event_id) AS action_id FROM events r JOIN events a ON a.user_id = r.user_id AND a.event_type = 'view' WHERE r.event_type = 'error' AND r.event_id % 10 <> 0 AND epoch_us(r.ts) - epoch_us(a.ts) BETWEEN 0 AND 360000000000 GROUP BY 1 HAVING count(*) = 1)
    SELECT e.event_id AS run_id, CASE WHEN e.event_id % 10 = 0 THEN 'history_port' WHEN n.action_id IS NULL THEN 'local' ELSE 'ci' END AS origin_kind, n.action_id FROM events e LEFT JOIN n ON n.event_id = e.event_id WHERE e.event_type = 'error'""")
def derive_run_origin(spark, sf_dir):
    """Errors with the one view of their user in the 100 hours before, were errors runs and views workflows that name them."""
    e = read(spark, sf_dir, "events")
    runs = e.filter("event_type = 'error'").select(F.col("event_id").alias("run_id"), F.col("ts").alias("started_at"), (F.col("event_id") % 10 == 0).alias("ported"), "user_id")
    actions = e.filter("event_type = 'view'").select(F.col("event_id").alias("action_id"), F.col("ts").alias("action_at"), "user_id")
    logs = runs.select("run_id", "user_id").join(actions.select("action_id", "user_id"), "user_id").select("action_id", "run_id")
    return origin.derive_origin(runs.drop("user_id"), actions.drop("user_id"), logs, 6000 * 60)


@query("SELECT s_nationkey AS nation FROM supplier EXCEPT SELECT c_nationkey FROM customer WHERE c_custkey % 301 = 0")
def except_distinct(spark, sf_dir):
    """Nations of suppliers that some customers don't have."""
    return read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")).subtract(read(spark, sf_dir, "customer").filter("c_custkey % 301 = 0").select("c_nationkey"))


@query("SELECT 'orders' AS table_name, year(o_orderdate)::VARCHAR AS season, count(*) AS n_rows FROM orders GROUP BY 2 UNION ALL SELECT 'nation', NULL, count(*) FROM nation")
def build_shape(spark, sf_dir):
    """Rows of relations by season."""
    return builds.build_shape({"orders": _orders(spark, sf_dir), "nation": read(spark, sf_dir, "nation")})


@query("SELECT page_id, parse_filename(url) AS name, parse_filename(url, true) AS stem, string_split(url, '/')[-3] AS third_from_end FROM pages")
def path_parts(spark, sf_dir):
    """The last part of each page's address, with and without its extension, and the third from the end."""
    return read(spark, sf_dir, "pages").select("page_id", parse_filename(F.col("url")).alias("name"), parse_filename(F.col("url"), True).alias("stem"), segment(F.col("url"), -3).alias("third_from_end"))


@query("SELECT o_orderkey, strptime(CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y%m%dT%H%M%SZ') END, '%Y%m%dT%H%M%SZ') AS parsed, make_date(year(o_orderdate), month(o_orderdate), day(o_orderdate)) AS day FROM orders")
def run_moments(spark, sf_dir):
    """Moments read from text as run ids write them, and dates from their parts."""
    o = read(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 7 != 0, F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss'Z'"))
    return o.select("o_orderkey", strptime(text, "%Y%m%dT%H%M%SZ").alias("parsed"), make_date(F.year("o_orderdate"), F.month("o_orderdate"), F.day("o_orderdate")).alias("day"))


@query("SELECT o_orderkey, count(*) FILTER (o_orderstatus = 'F') OVER (PARTITION BY o_custkey) AS n_final FROM orders")
def filtered_count_over_partition(spark, sf_dir):
    """Each order with the number of its customer's final ones, counted first and joined back, so that a customer's orders need not meet in one task."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    n = o.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("n_final"))
    return o.join(n, "o_custkey").select("o_orderkey", "n_final")


@query("SELECT o_custkey, to_json(list(o_orderkey ORDER BY o_orderdate, o_orderkey))::VARCHAR AS orders_json FROM orders GROUP BY 1")
def json_group_array(spark, sf_dir):
    """Each customer's orders as a JSON array, oldest first."""
    each = F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey")))
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_json(F.transform(each, lambda x: x["o_orderkey"])).alias("orders_json"))
