"""Reuse of stored results by request fingerprint."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkq.plans.ordered import HOT_GROUP_ROWS, Running, hashable, scan_in_order
from sparkq.plans.staging import stage

DEFAULT_TTL_SECONDS = 60
CACHEABLE_MODES = ("single", "many", "scalar", "resource_contents")


def check_cacheable(row_mode: str, is_procedure: bool = False) -> None:
    """Refuse to reuse results of writes, streams and procedures."""
    if is_procedure or row_mode not in CACHEABLE_MODES:
        raise ValueError(f"results of {row_mode!r} (procedure: {is_procedure}) are not reusable")


def fresh_results(
    results: DataFrame,
    now: datetime,
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
    computed_at: str = "computed_at",
) -> DataFrame:
    """Stored results that have not expired; a TTL of 0 never expires.

    A result computed after ``now`` is not there yet.
    """
    at = F.lit(now).cast("timestamp")
    results = results.where(F.col(computed_at).cast("timestamp") <= at)
    if ttl_seconds == 0:
        return results
    age = at - F.col(computed_at).cast("timestamp")
    return results.where(age <= F.make_dt_interval(secs=F.lit(ttl_seconds)))


def _same(left: str, right: str) -> Column:
    # A plain equality would also filter out nulls, and that filter, pushed below
    # the projection, would compute every fingerprint a second time.
    return F.col(left).eqNullSafe(F.col(right))


def missing_requests(
    requests: DataFrame, fresh: DataFrame, fingerprint: str = "fingerprint"
) -> DataFrame:
    """One row per fingerprint that no fresh result answers.

    Requests are made distinct before the join, so a popular request is one row
    in it.
    """
    wanted = requests.groupBy(fingerprint).agg(F.count("*").alias("n_requests"))
    have = fresh.select(F.col(fingerprint).alias("__have")).distinct()
    return wanted.join(have, _same(fingerprint, "__have"), "left_anti")


def answer_requests(
    requests: DataFrame,
    fresh: DataFrame,
    compute: Callable[[DataFrame], DataFrame],
    fingerprint: str = "fingerprint",
    body: str = "body",
    stored_with: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Every request with the body that answers it and ``outcome`` (hit or miss), and the
    new results to append to the store.

    ``fresh`` has one body per fingerprint. ``compute`` gets one row of every request
    that it does not answer and returns (fingerprint, body); it runs once, as its result
    is written. Requests of one fingerprint share its body. ``stored_with`` names columns
    that are stored and answered with the body, such as the flag of a truncated result.
    """
    answer = [body, *stored_with]
    kept = F.struct(*[F.col(c) for c in requests.columns])
    # Maps have no order, so they do not help to pick the row.
    order = [F.col(f.name) for f in requests.schema if hashable(f.dataType)]
    one_each = (
        requests.groupBy(F.col(fingerprint).alias("__print"))
        .agg(F.min_by(kept, F.struct(*order)).alias("__row"))
        .join(fresh.select(F.col(fingerprint).alias("__have")), _same("__print", "__have"), "left_anti")
        .select("__row.*")
    )
    new = stage(compute(one_each).select(fingerprint, *answer), "results")
    known = fresh.select(fingerprint, *answer, F.lit("hit").alias("__o")).unionByName(
        new.withColumn("__o", F.lit("miss"))
    )
    # Staged, so that Spark may split a fingerprint that very many requests share.
    known = stage(known, "known").select(
        F.col(fingerprint).alias("__print"), *[F.col(c).alias(f"__a{i}") for i, c in enumerate(answer)], "__o"
    )
    names = [c for c in requests.columns if c not in (*answer, "outcome")]
    answered = requests.join(known, _same(fingerprint, "__print"), "left").select(
        *names, *[F.col(f"__a{i}").alias(c) for i, c in enumerate(answer)], F.col("__o").alias("outcome")
    )
    return answered, new


def _on_chains(roots: DataFrame, following: DataFrame) -> DataFrame:
    """Nodes ``n`` that the roots reach over the pointers (n, to).

    Pointers double in length each round, and what is reached jumps by them, so a chain
    of any length takes as many rounds as its length has bits.
    """
    reached, jumps = stage(roots, "reached"), stage(following, "jumps")
    while not jumps.isEmpty():
        further = reached.join(jumps, "n").select(F.col("to").alias("n"))
        reached = stage(reached.unionByName(further).distinct(), "reached")
        onward = jumps.select(F.col("n").alias("to"), F.col("to").alias("then"))
        jumps = stage(jumps.join(onward, "to").select("n", F.col("then").alias("to")), "jumps")
    return reached


def reuse_within_ttl(
    requests: DataFrame,
    ok: Column,
    at: str,
    tie: Sequence[str],
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
    stored: DataFrame | None = None,
    fingerprint: str = "fingerprint",
    computed_at: str = "computed_at",
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Replay a log of requests against a store whose results expire.

    Adds ``outcome`` (``hit`` or ``miss``), ``written`` (the request was a miss and, as
    ``ok`` says, its result was stored) and ``stored_at``, the time of the result that
    answers: its own for a request that writes, null for other misses. A result answers
    up to and including ``ttl_seconds`` after it was stored (0: for ever); a hit does not
    renew it. Requests of one fingerprint come in the order of ``at`` and ``tie``.
    ``stored`` has results (fingerprint, computed_at) that are put into the store from
    elsewhere, each before the requests of its own instant and over what is there.
    A request without a time is a miss and stores nothing.

    Only some successful requests write: the first, then each time the first one after
    the expiry of the last. So every success points to the first success past its own
    expiry, and the writes are what the first successes of their fingerprint, and those
    after a pause longer than the TTL, reach over these pointers. The chain is followed
    by doubling, never row by row, and no fingerprint has to fit into one task.
    """
    us = F.unix_micros(F.col(at).cast("timestamp"))
    rows = stage(
        requests.withColumns({"__n": F.monotonically_increasing_id(), "__us": us, "__ok": F.coalesce(ok, F.lit(False))}),
        "requests",
    )
    columns = [*[F.col(c).alias(f"__t{i}") for i, c in enumerate(tie)]]
    nodes = rows.where("__ok AND __us IS NOT NULL").select(
        F.col(fingerprint).alias("p"), "__n", "__us", F.lit(False).alias("put"), *columns
    )
    if stored is not None:
        puts = stored.select(F.col(fingerprint).alias("p"), F.unix_micros(F.col(computed_at).cast("timestamp")).alias("__us"))
        puts = stage(puts.where("__us IS NOT NULL").distinct(), "puts")
        nodes = nodes.unionByName(
            puts.select("p", (-1 - F.monotonically_increasing_id()).alias("__n"), "__us", F.lit(True).alias("put")),
            allowMissingColumns=True,
        )
    nodes = stage(nodes, "nodes")
    order = ["__us", "first", *[f"__t{i}" for i in range(len(tie))], "__n"]
    nodes = nodes.withColumn("first", ~F.col("put"))
    # What has no result in the TTL before it finds the store empty, and writes.
    before = scan_in_order(nodes, ["p"], order, [Running("prev", "prev", F.col("__us"))], hot_rows)
    width = ttl_seconds * 1_000_000
    pause = F.col("prev").isNull() if ttl_seconds == 0 else F.col("prev").isNull() | (F.col("__us") - F.col("prev") > width)
    # A root needs no pointer to it, so chains end there.
    marked = stage(before.withColumn("root", pause | F.col("put")), "nodes")
    pointers = _next_writes(marked, order, width, stored is not None, hot_rows)
    roots = marked.where("root").select(F.col("__n").alias("n"))
    candidates = roots.unionByName(pointers.select(F.col("to").alias("n"))).distinct()
    written = _on_chains(roots, pointers.join(candidates, "n", "left_semi"))

    marks = stage(marked.join(written.withColumnRenamed("n", "__n"), "__n", "left_semi"), "writes")
    seen = rows.select(
        F.col(fingerprint).alias("p"), "__n", "__us", F.lit(True).alias("first"), *columns, F.lit(False).alias("put")
    ).where("__us IS NOT NULL")
    flags = marks.select("__n", F.lit(True).alias("written"))
    # Stored results are nodes of their own; requests that write carry their flag.
    seen = seen.join(flags, "__n", "left").unionByName(
        marks.where("put").select("p", "__n", "__us", "first", "put", F.lit(True).alias("written")), allowMissingColumns=True
    )
    last = scan_in_order(
        seen, ["p"], order, [Running("last", "max", F.when(F.col("written"), F.col("__us")))], hot_rows
    ).where("NOT put")
    alive = F.col("last").isNotNull() if ttl_seconds == 0 else F.coalesce(F.col("__us") - F.col("last") <= width, F.lit(False))
    wrote = F.coalesce("written", F.lit(False))
    verdict = last.select(
        F.col("__n").alias("__v"), wrote.alias("__w"), (alive & ~wrote).alias("__h"), F.when(alive, F.col("last")).alias("__s")
    )
    kind = requests.schema[at].dataType
    back = F.timestamp_micros("__s").cast(kind)
    return rows.join(verdict, F.col("__n") == F.col("__v"), "left").select(
        *requests.columns,
        F.when(F.col("__h"), "hit").otherwise("miss").alias("outcome"),
        F.coalesce("__w", F.lit(False)).alias("written"),
        back.alias("stored_at"),
    )


def _next_writes(
    nodes: DataFrame, order: Sequence[str], width: int, with_puts: bool, hot_rows: int
) -> DataFrame:
    """Pointers (n, to) from each node to what would write next, were it a write: the
    first node past its expiry, or a result put into the store before that. Pointers to
    roots are left out."""
    what = F.struct(*order, "root")
    none = F.lit(None).cast(nodes.select(what.alias("w")).schema["w"].dataType)

    def rows(time: Column, kind: int, of: Column, any_: Column, put: Column) -> DataFrame:
        return nodes.select(
            "p", (-time).alias("back"), F.lit(kind).alias("kind"), "__n", of.alias("of"), any_.alias("any"), put.alias("put")
        )

    # Scanned from the end of time; a probe comes before the nodes of its own instant.
    points = rows(F.col("__us"), 2, F.lit(None).cast("long"), what, F.when(F.col("put"), what))
    steps, following = [], []
    if width:
        points = points.unionByName(rows(F.col("__us") + width, 0, F.col("__n"), none, none))
        steps.append(Running("next_any", "min", F.col("any")))
        following.append(F.when(F.col("kind") == 0, F.col("next_any")))
    if with_puts:
        points = points.unionByName(rows(F.col("__us"), 1, F.col("__n"), none, none))
        steps.append(Running("next_put", "min", F.col("put")))
        following.append(F.when(F.col("kind") == 1, F.col("next_put")))
    if not steps:
        return nodes.select(F.col("__n").alias("n"), F.col("__n").alias("to")).limit(0)
    scanned = scan_in_order(points, ["p"], ["back", "kind", "__n"], steps, hot_rows).where("of IS NOT NULL")
    found = scanned.select("of", F.coalesce(*following).alias("to")).where("to IS NOT NULL")
    # Dealt out first: a minimum of structs sorts, and a task that scans holds rows enough.
    least = found.repartition("of").groupBy("of").agg(F.min("to").alias("to"))
    return least.where("NOT to.root").select(F.col("of").alias("n"), F.col("to.__n").alias("to"))


def reuse_outcomes(
    requests: DataFrame,
    fresh: DataFrame,
    labels: Sequence[str] = ("backend", "driver"),
    fingerprint: str = "fingerprint",
    order: Sequence[str] = ("started_at", "request_id"),
    success: Mapping[str, str] | None = None,
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
) -> DataFrame:
    """Cache hits, misses and writes per label of one batch of requests.

    A request hits when a fresh result exists or an earlier successful request of the
    batch, stored no longer than ``ttl_seconds`` ago, has the same fingerprint; else it
    misses. Successful misses are written. What ``fresh`` holds answers all of the batch.
    """
    column, value = next(iter((success or {"status": "success"}).items()))
    have = fresh.select(F.col(fingerprint).alias("__have")).distinct()
    ok = F.col(column) == value
    replayed = reuse_within_ttl(requests, ok, order[0], order[1:], ttl_seconds, fingerprint=fingerprint)
    tagged = replayed.join(have, _same(fingerprint, "__have"), "left")
    hit = F.col("__have").isNotNull() | (F.col("outcome") == "hit")
    return tagged.groupBy(*labels).agg(
        F.count_if(hit).alias("hits"),
        F.count_if(~hit).alias("misses"),
        F.count_if(~hit & ok).alias("writes"),
    )
