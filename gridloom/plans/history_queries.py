"""Queries over events and ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.operators import entities, history
from gridloom.plans.registry import query, table


@query("""SELECT event_id, user_id || '#' || row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS seq FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 10""")
def recent_changes(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return history.newest_first(e, "user_id", [F.desc("ts"), F.desc("event_id")]).where("k <= 10").select("event_id", "seq")


@query("""SELECT event_id, prev, v FROM (SELECT event_id, floor(value / 25) AS v, lag(floor(value / 25)) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev FROM events) WHERE prev IS NOT NULL AND prev <> v""")
def adjacent_changes(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("v", F.floor(F.col("value") / 25).cast("double"))
    return history.changes(e, ["user_id", "event_type"], ["ts", "event_id"], "v").select("event_id", "prev", "v")


@query("""SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2""")
def latest_values(spark, sf_dir):
    return history.latest(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["value", "event_id"])


@query("""SELECT event_id, coalesce(max(CASE WHEN event_type <> 'error' THEN event_id END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) IS NOT NULL, false) AS overwritten FROM events""")
def overwritten_later(spark, sf_dir):
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(1, W.unboundedFollowing)
    return table(spark, sf_dir, "events").select("event_id", F.max(F.when(F.col("event_type") != "error", F.col("event_id"))).over(w).isNotNull().alias("overwritten"))


@query("""SELECT user_id, count(*) FILTER (event_type = 'purchase') AS ok, count(*) FILTER (event_type = 'error') AS failed, max(ts) FILTER (event_type = 'purchase') AS last_ok, coalesce(max(ts) FILTER (event_type = 'purchase') > max(ts) FILTER (event_type = 'error'), false) AS recovered FROM events GROUP BY 1""")
def sync_summary(spark, sf_dir):
    ok, bad = F.col("event_type") == "purchase", F.col("event_type") == "error"
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(ok).alias("ok"), F.count_if(bad).alias("failed"), F.max(F.when(ok, F.col("ts"))).alias("last_ok"), F.coalesce(F.max(F.when(ok, F.col("ts"))) > F.max(F.when(bad, F.col("ts"))), F.lit(False)).alias("recovered"))


@query("""SELECT event_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run, (sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) % 2)::BIGINT AS stripe FROM (SELECT *, (coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id), '') <> event_type)::INT AS new FROM events)""")
def runs_and_stripes(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    e = e.withColumn("new", F.coalesce(F.lag("event_type").over(W.partitionBy("user_id").orderBy("ts", "event_id")), F.lit("")) != F.col("event_type"))
    return history.runs(e, "user_id", ["ts", "event_id"], F.col("new")).select("event_id", "run", (F.col("run") % 2).alias("stripe"))


@query("""SELECT event_id, sum(CASE WHEN event_type = 'purchase' THEN -floor(value) ELSE floor(value) END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS balance FROM events""")
def running_balances(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    v = F.floor("value").cast("double")
    return history.running_balance(e, "user_id", ["ts", "event_id"], F.when(e.event_type == "purchase", -v).otherwise(v)).select("event_id", "balance")


@query("""WITH cp AS (SELECT user_id, arg_max(floor(value), event_id) AS base, max(event_id) AS at FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT cp.user_id, base, base + coalesce((SELECT sum(floor(value)) FROM events e WHERE e.user_id = cp.user_id AND e.event_id > cp.at AND event_type <> 'signup'), 0) AS expected FROM cp""")
def balance_checkpoints(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("qty", F.floor("value").cast("double"))
    return history.balance_audit(e, "user_id", "event_id", F.col("event_type") == "signup", "qty", "qty")


@query("""SELECT event_id, n AS in_window, n > 3 AS rejected FROM (SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 86400 SECONDS PRECEDING AND CURRENT ROW) AS n FROM events)""")
def rate_limit(spark, sf_dir):
    return history.rate_limited(table(spark, sf_dir, "events"), "user_id", "ts", 86_400, 3).select("event_id", "in_window", "rejected")


@query("""WITH l AS (SELECT * FROM events WHERE event_type = 'purchase'), r AS (SELECT * FROM events WHERE event_type = 'view')
SELECT l.event_id, r.event_id AS match_event_id, r.value AS match_value FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts""")
def asof_match(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return history.asof(e.where("event_type = 'purchase'").select("user_id", "ts", "event_id"), e.where("event_type = 'view'"), "user_id", "ts", ["event_id", "value"], "event_id").select("event_id", "match_event_id", "match_value")


@query("""WITH RECURSIVE k AS (SELECT user_id, count(*) AS rows, row_number() OVER (ORDER BY user_id) AS i FROM events GROUP BY 1), r AS (SELECT i, user_id, rows, 0::BIGINT AS chunk, rows AS size FROM k WHERE i = 1
UNION ALL SELECT k.i, k.user_id, k.rows, r.chunk + (r.size + k.rows > 500)::BIGINT, CASE WHEN r.size + k.rows > 500 THEN k.rows ELSE r.size + k.rows END FROM r JOIN k ON k.i = r.i + 1) SELECT user_id, rows, chunk FROM r""")
def aligned_chunks(spark, sf_dir):
    return history.key_aligned_chunks(table(spark, sf_dir, "events"), "user_id", 500)


@query()
def stock_transactions(spark, sf_dir):
    """Orders as withdrawals, one after another, each booked whole or not at all. What one finds depends on all before it, so it is held against a plain loop in the tests."""
    moved = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("txn"), F.col("l_orderkey").alias("at"), F.col("l_partkey").alias("pn"), (-F.col("l_quantity")).alias("delta"))
    stock = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pn"), (F.col("p_size") * 2).alias("qty"))
    return history.settled(moved, stock, "txn", "at", "pn", "delta", "qty")


@query("""WITH l AS (SELECT l_orderkey AS txn, l_partkey AS pn, -sum(l_quantity) AS delta FROM lineitem GROUP BY 1, 2), b AS (SELECT *, 500 + sum(delta) OVER (PARTITION BY pn ORDER BY txn ROWS UNBOUNDED PRECEDING) AS qty FROM l),
q AS (SELECT o_orderkey * 2 AS txn FROM orders) SELECT q.txn, pn, delta, qty, coalesce(qty <= p_size * 5, false) AS low, pn IS NOT NULL AS known FROM q LEFT JOIN b USING (txn) LEFT JOIN part ON p_partkey = pn""")
def idempotent_transactions(spark, sf_dir):
    """Every second number is asked for again: those that were booked give their first answer, the others none."""
    per = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("txn"), F.col("l_partkey").alias("pn")).agg((-F.sum("l_quantity")).alias("delta"))
    ledger = history.running_balance(per, "pn", ["txn"], F.col("delta")).withColumn("balance", F.col("balance") + 500).withColumn("id", F.col("txn"))
    asked = table(spark, sf_dir, "orders").select((F.col("o_orderkey") * 2).alias("txn"))
    return history.replayed(asked, ledger, table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pn"), (F.col("p_size") * 5).alias("min")))


@query("""SELECT user_id, min(rn) - 1 AS first_row, count(*) AS n FROM (SELECT user_id, row_number() OVER (ORDER BY user_id, ts, event_id) AS rn FROM events) GROUP BY 1""")
def link_index(spark, sf_dir):
    """First row and number of rows of each key in key order: a count for each key, added up in ranges of keys."""
    n = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return entities.running(n, "user_id", "n", "first_row")


@query("""WITH e AS (SELECT user_id, event_type, ts, count(*) AS together, event_type IN ('purchase', 'error') AS ext FROM events GROUP BY 1, 2, 3), s AS (SELECT user_id, 'any' AS scope, ts, event_type, together FROM e UNION ALL SELECT user_id, 'external', ts, event_type, together FROM e WHERE ext)
SELECT user_id, scope, ts, event_type, together FROM s QUALIFY row_number() OVER (PARTITION BY user_id, scope ORDER BY ts DESC, event_type DESC) = 1""")
def last_changes(spark, sf_dir):
    return history.last_changes(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_type"], F.col("event_type").isin("purchase", "error"))


@query("""WITH e AS (SELECT user_id AS device, event_id % 5 AS place, ts, event_id, event_type IN ('signup', 'view') AS coming FROM events), n AS (SELECT *, lead(ts) OVER (PARTITION BY device, place ORDER BY ts, event_id) AS until FROM e)
SELECT device, place, ts AS since, until, row_number() OVER (PARTITION BY device ORDER BY ts DESC, event_id DESC, place DESC) AS k, until IS NULL AS open FROM n WHERE coming""")
def assignment_history(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("device"), (F.col("event_id") % 5).alias("place"), "ts", "event_id", "event_type")
    return history.assignments(e, "device", "place", ["ts", "event_id"], F.col("event_type").isin("signup", "view"))


@query("""WITH v AS (SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2) SELECT user_id, arg_min(event_type, list_position(['signup', 'error', 'click'], event_type)) AS event_type, arg_min(value, list_position(['signup', 'error', 'click'], event_type)) AS value
FROM v WHERE event_type IN ('signup', 'error', 'click') GROUP BY 1""")
def first_available(spark, sf_dir):
    v = history.latest(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["value"])
    return history.first_available(v, "user_id", "event_type", "value", ["signup", "error", "click"])


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_returnflag <> 'R', l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate) AS k FROM lineitem), p AS (SELECT l_partkey, l_suppkey AS primary, l_quantity AS value FROM r WHERE k = 1)
SELECT p.l_partkey, p.primary, p.value, count(*) AS sources, coalesce(list(DISTINCT l_suppkey ORDER BY l_suppkey) FILTER (l_quantity <> p.value), []) AS differing FROM lineitem l JOIN p USING (l_partkey) GROUP BY 1, 2, 3""")
def consensus(spark, sf_dir):
    """Each part's first supplier, returned goods first, and the suppliers whose quantity is another."""
    return history.consensus(table(spark, sf_dir, "lineitem"), "l_partkey", ["l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"], F.col("l_returnflag") == "R", "l_quantity", "l_suppkey")


@query(r"""SELECT user_id, arg_max(props, (ts, event_id)) AS props, regexp_extract(arg_max(props, (ts, event_id)), '([0-9]+)', 1) AS revision FROM events GROUP BY 1""")
def latest_snapshots(spark, sf_dir):
    return history.latest_snapshot(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "props", "([0-9]+)")


@query(r"""SELECT event_id, ts, regexp_extract(props, '([0-9]+)', 1) AS serial, s_suppkey FROM events JOIN supplier ON regexp_extract(props, '([0-9]+)', 1) = (s_suppkey * 3)::VARCHAR WHERE event_type = 'error'""")
def rebuilt_devices(spark, sf_dir):
    devices = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") * 3).cast("string").alias("no"))
    return history.rebuilt(table(spark, sf_dir, "events").where("event_type = 'error'"), "event_id", "ts", "props", "([0-9]+)", devices, "s_suppkey", "no")


@query("""WITH cp AS (SELECT user_id, arg_max(floor(value), event_id) AS base, max(event_id) AS at FROM events WHERE event_type = 'signup' GROUP BY 1), x AS (SELECT cp.user_id, base, base + coalesce((SELECT sum(floor(value)) FROM events e WHERE e.user_id = cp.user_id AND e.event_id > cp.at AND event_type <> 'signup'), 0) AS expected FROM cp)
SELECT user_id, base, expected, c_acctbal AS qty, coalesce(expected = c_acctbal, false) AS ok FROM x LEFT JOIN customer ON c_custkey = user_id""")
def stored_stock_audit(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("qty", F.floor("value").cast("double"))
    items = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("qty"))
    return history.stock_audit(e, items, "user_id", "event_id", F.col("event_type") == "signup", "qty", "qty", "qty")


@query("""SELECT event_id, user_id, event_type FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-05' AND event_id < 900 ORDER BY event_id DESC LIMIT 40""")
def log_page(spark, sf_dir):
    """A page of forty errors before a cursor; the end of the time span is no date and does not count."""
    return history.log_filter(table(spark, sf_dir, "events"), {"event_type": "error", "props": ""}, "ts", since="2024-01-05", until="next week", id_="event_id", before=900, most=40).select("event_id", "user_id", "event_type")


@query("""SELECT user_id, max(ts) FILTER (event_type = 'purchase') AS last_ok, date_diff('day', max(ts) FILTER (event_type = 'purchase'), TIMESTAMP '2024-02-01') AS days FROM events GROUP BY 1""")
def days_since_success(spark, sf_dir):
    last = F.max(F.when(F.col("event_type") == "purchase", F.col("ts")))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(last.alias("last_ok")).withColumn("days", history.days_since(F.col("last_ok"), F.lit("2024-02-01").cast("date")).cast("long"))


@query("""SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, avg(value) AS mean FROM events GROUP BY 1, 2""")
def tumbling_days(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean")).select(F.col("w.start").alias("day"), "event_type", "n", "mean")
