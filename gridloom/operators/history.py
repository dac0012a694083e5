"""Event history: sequences, changes, latest values, balances, runs, rate limits."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from gridloom.session import kept, ship


def newest_first(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """seq = key#k, 1 being the newest; blank keys get ''."""
    k = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("k", k).withColumn("seq", F.when(F.coalesce(F.col(key).cast("string"), F.lit("")) == "", "").otherwise(F.concat(F.col(key).cast("string"), F.lit("#"), F.col("k"))))


def changes(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the one before them, with it as prev."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("prev", F.lag(value).over(w)).where(F.col("prev").isNotNull() & (F.col("prev") != F.col(value)))


def latest(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Columns of each key's last row: one aggregation with partial combining, no sort."""
    best = F.max_by(F.struct(*columns), F.struct(*order)).alias("x")
    return df.groupBy(*keys).agg(best).select(*keys, "x.*")


def running_balance(df: DataFrame, key: str, order: list[str], delta: Column) -> DataFrame:
    return df.withColumn("balance", F.sum(delta).over(W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)))


def balance_audit(ledger: DataFrame, key: str, order: str, checkpoint: Column, balance: str, delta: str) -> DataFrame:
    """expected = newest checkpoint's balance and the deltas after it; keys without a checkpoint are left out."""
    last = ledger.groupBy(key).agg(F.max(F.when(checkpoint, F.struct(order, balance))).alias("cp")).where("cp IS NOT NULL")
    after = ledger.join(last, key).where((F.col(order) > F.col(f"cp.{order}")) & ~checkpoint).groupBy(key).agg(F.sum(delta).alias("moved"))
    return last.join(after, key, "left").select(key, F.col(f"cp.{balance}").alias("base"), (F.col(f"cp.{balance}") + F.coalesce("moved", F.lit(0))).alias("expected"))


def runs(df: DataFrame, key: str, order: list[str], starts: Column) -> DataFrame:
    """Gaps and islands: run counts how often starts has held so far in the key."""
    w = W.partitionBy(key).orderBy(*order)
    return df.withColumn("run", F.sum(F.when(starts, 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))


def rate_limited(df: DataFrame, key: str, ts: str, seconds: int, most: int) -> DataFrame:
    """in_window: rows of the key in the trailing seconds, this one included; rejected beyond `most`."""
    w = W.partitionBy(key).orderBy(F.unix_micros(F.col(ts).cast("timestamp"))).rangeBetween(-seconds * 1_000_000, 0)
    return df.withColumn("in_window", F.count(F.lit(1)).over(w)).withColumn("rejected", F.col("in_window") > most)


def asof(left: DataFrame, right: DataFrame, key: str, ts: str, columns: list[str], tiebreak: str) -> DataFrame:
    """Each left row with the columns of the last right row of its key at or before its time: a union and one window, no join."""
    r = right.select(F.col(key), F.col(ts), F.lit(0).alias("_side"), F.col(tiebreak).alias("_tie"), F.struct(*columns).alias("_r"))
    out = [c for c in left.columns if c not in (key, ts)]
    lft = left.select(F.col(key), F.col(ts), F.lit(1).alias("_side"), F.col(tiebreak).alias("_tie"), *(F.col(c).alias(f"l_{c}") for c in out))
    both = r.unionByName(lft, allowMissingColumns=True)
    w = W.partitionBy(key).orderBy(ts, "_side", "_tie").rowsBetween(W.unboundedPreceding, W.currentRow)
    got = both.withColumn("_m", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    return got.select(key, ts, *(F.col(f"l_{c}").alias(c) for c in out), *(F.col(f"_m.{c}").alias(f"match_{c}") for c in columns))


def key_aligned_chunks(df: DataFrame, key: str, target: int) -> DataFrame:
    """key, rows, chunk: whole keys in order fill a chunk as long as it stays within target rows; a key of more makes a chunk of its own. Where a chunk begins
    depends on all before it, so one row a key is streamed through one task that holds a counter; the rows themselves are not moved."""

    def filled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk, size = 0, 0
        for b in batches:
            at = []
            for n in b["rows"].tolist():
                if size and size + n > target:
                    chunk, size = chunk + 1, 0
                size += n
                at.append(chunk)
            yield b.assign(chunk=at)

    ship(df.sparkSession)
    blocks = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return blocks.repartition(1).sortWithinPartitions(key).mapInPandas(filled, f"{key} {dict(df.dtypes)[key]}, rows long, chunk long")


def settled(deltas: DataFrame, stock: DataFrame, txn: str, order: str, key: str, delta: str, qty: str) -> DataFrame:
    """txn, key, delta, ok of a ledger: deltas of a transaction are added by key, transactions are taken one after another (by their least order, then
    txn), and one that would take any key below zero or names an unknown key is refused whole.

    Nothing is folded one by one: each round brackets the balance that a transaction still open finds, by what those open before it may take or bring at
    most. It is settled where both ends say the same, and the first open one of all always is; so rounds are as many as decisions hang on one another.
    """
    first = deltas.groupBy(txn).agg(F.min(order).alias("_o"))
    rows = deltas.groupBy(txn, key).agg(F.sum(delta).alias(delta)).join(first, txn).join(stock.select(key, F.col(qty).alias("_q")), key, "left")
    refused = rows.where("_q IS NULL").select(txn).distinct()
    rows = kept(rows.join(refused, txn, "left_anti").withColumn("_ok", F.lit(None).cast("boolean")))
    done = deltas.select(txn).distinct().join(refused, txn).select(txn, F.lit(False).alias("ok"))
    before = W.partitionBy(key).orderBy("_o", txn).rowsBetween(W.unboundedPreceding, -1)
    sums = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    while not rows.where("_ok IS NULL").isEmpty():
        sure = F.col("_q") + sums(F.when(F.col("_ok"), F.col(delta))) + F.col(delta)
        open_ = F.col("_ok").isNull()
        low, high = sure + sums(F.when(open_, F.least(F.col(delta), F.lit(0)))), sure + sums(F.when(open_, F.greatest(F.col(delta), F.lit(0))))
        bounds = rows.select(txn, "_ok", low.alias("_low"), high.alias("_high")).where("_ok IS NULL").groupBy(txn).agg(F.min("_low").alias("_low"), F.min("_high").alias("_high"))
        now = kept(bounds.select(txn, F.when(F.col("_low") >= 0, True).when(F.col("_high") < 0, False).alias("ok")).where("ok IS NOT NULL"))
        done = done.unionByName(now)
        rows = rows.join(now, txn, "left").withColumn("_ok", F.coalesce("_ok", "ok")).drop("ok").where("_ok IS NULL OR _ok")
        # keys without an open transaction have nothing more to tell
        live = rows.where("_ok IS NULL").select(key).distinct()
        rows = kept(rows.join(live, key, "left_semi"))
    merged = deltas.groupBy(txn, key).agg(F.sum(delta).alias(delta))
    return merged.join(done, txn).select(txn, key, delta, "ok")


def replayed(requests: DataFrame, ledger: DataFrame, items: DataFrame) -> DataFrame:
    """requests (txn), ledger (id, txn, pn, delta, balance), items (pn, min) -> txn, pn, delta, qty, low, known: a transaction that was booked before gives its
    first answer again, row by row; one that was not gives one row without any."""
    was = ledger.join(items.select("pn", "min"), "pn", "left").select("txn", "id", "pn", "delta", F.col("balance").alias("qty"), (F.coalesce(F.col("balance") <= F.col("min"), F.lit(False))).alias("low"))
    return requests.select("txn").distinct().join(was, "txn", "left").withColumn("known", F.col("id").isNotNull()).withColumn("low", F.coalesce("low", F.lit(False))).drop("id")


def last_changes(df: DataFrame, keys: list[str], event: list[str], external: Column) -> DataFrame:
    """For each key its last change and its last external one (scope 'any', 'external'), with how many rows of the key the same event changed; event: columns
    that order events and tell them apart."""
    at = F.struct(*event)
    per = df.withColumn("_x", F.coalesce(external, F.lit(False))).groupBy(*keys, *event).agg(F.count(F.lit(1)).alias("together"), F.max("_x").alias("_x"))
    pick = lambda when: F.max(F.when(when, F.struct(at.alias("at"), "together")))
    both = per.groupBy(*keys).agg(pick(F.lit(True)).alias("any"), pick(F.col("_x")).alias("external"))
    out = both.select(*keys, F.explode(F.array(*(F.struct(F.lit(s).alias("scope"), F.col(s).alias("x")) for s in ("any", "external")))).alias("y")).where("y.x IS NOT NULL")
    return out.select(*keys, "y.scope", "y.x.at.*", "y.x.together")


def assignments(events: DataFrame, entity: str, place: str, order: list[str], coming: Column) -> DataFrame:
    """entity, place, since, until, k, open: each stay of an entity at a place, from the row that brings it in to the next row of the entity at that place that takes it out or
    brings another stay; k counts from the newest stay. A stay without an end is open."""
    w = W.partitionBy(entity, place).orderBy(*order)
    spans = events.withColumn("_in", coming).withColumn("until", F.lead(F.struct(*order)).over(w)).where("_in")
    newest = W.partitionBy(entity).orderBy(*(F.desc(c) for c in order), F.desc(place))
    return spans.select(entity, place, F.col(order[0]).alias("since"), F.col(f"until.{order[0]}").alias("until"), F.row_number().over(newest).alias("k"), F.col("until").isNull().alias("open"))


def first_available(values: DataFrame, entity: str, name: str, value: str, names: list[str]) -> DataFrame:
    """entity, name, value: of an ordered list of names the first that the entity has a value for."""
    rank = F.array_position(F.array(*map(F.lit, names)), F.col(name))
    return values.where((rank > 0) & F.col(value).isNotNull()).groupBy(entity).agg(F.min_by(F.struct(name, value), rank).alias("x")).select(entity, f"x.{name}", f"x.{value}")


def consensus(values: DataFrame, entity: str, order: list[str], preferred: Column, value: str, channel: str) -> DataFrame:
    """entity, primary channel and value, sources, differing: the first channel in order, preferred ones before others, and the sorted channels that say otherwise."""
    best = F.min_by(F.struct(channel, value), F.struct((~F.coalesce(preferred, F.lit(False))).alias("p"), *order)).alias("x")
    top = values.groupBy(entity).agg(best).select(entity, F.col(f"x.{channel}").alias("primary"), F.col(f"x.{value}").alias("value"))
    other = F.when(~F.col(value).eqNullSafe(F.col("_v")), F.col(channel))
    return values.join(top.select(entity, "primary", F.col("value").alias("_v")), entity).groupBy(entity, "primary", F.col("_v").alias("value")).agg(F.count(F.lit(1)).alias("sources"), F.array_sort(F.collect_set(other)).alias("differing"))


def latest_snapshot(blobs: DataFrame, entity: str, order: list[str], text: str, pattern: str) -> DataFrame:
    """entity, the newest row's text, and its revision by the pattern's first group ('' where it does not match)."""
    return latest(blobs, [entity], order, [text]).withColumn("revision", F.regexp_extract(text, pattern, 1))


def rebuilt(history: DataFrame, entity: str, order: str, text: str, pattern: str, devices: DataFrame, device: str, serial: str) -> DataFrame:
    """Delete and rebuild events whose text names a serial number, joined with the device that carries it."""
    told = history.withColumn("serial", F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))).where("serial IS NOT NULL")
    return told.join(devices.select(F.col(device), F.col(serial).alias("serial")), "serial").select(entity, order, "serial", device)


def stock_audit(ledger: DataFrame, items: DataFrame, key: str, order: str, checkpoint: Column, balance: str, delta: str, qty: str) -> DataFrame:
    """key, base, expected, qty, ok: the newest checkpoint's balance and the deltas after it against the stored quantity; keys without a checkpoint are left out."""
    return balance_audit(ledger, key, order, checkpoint, balance, delta).join(items.select(key, qty), key, "left").withColumn("ok", F.coalesce(F.col("expected") == F.col(qty), F.lit(False)))


def days_since(last: Column, today: Column) -> Column:
    """Whole days from one time to another; NULL where there is no time."""
    return F.datediff(today, last)


def log_filter(log: DataFrame, equal: dict[str, str], ts: str, since: str = "", until: str = "", id_: str = "id", before: int = 0, most: int = 1000) -> DataFrame:
    """A page of a log, newest first: each argument that is given narrows it (equal columns, since <= ts < until, ids below a cursor). Times that are no ISO dates count as not given."""
    out = log
    for c, v in equal.items():
        if v.strip():
            out = out.where(F.col(c) == v.strip())
    if iso_or_empty(since):
        out = out.where(F.col(ts) >= iso_or_empty(since))
    if iso_or_empty(until):
        out = out.where(F.col(ts) < iso_or_empty(until))
    if before > 0:
        out = out.where(F.col(id_) < before)
    return out.orderBy(F.desc(id_)).limit(max(1, min(most, 1000)))


def iso_or_empty(s: str) -> str:
    """s where it is an ISO 8601 date or time, else ''."""
    s = s.strip()
    return s if re.fullmatch(r"[0-9]{4}(-[0-9]{2}){2}(T[0-9:.]+Z?)?", s) else ""
