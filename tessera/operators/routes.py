"""Greedy nearest-unvisited routing over a distance table (PIP12, JN17, ARR4).

A *table of route requests* is advanced together, one hop at a time.  Cities
are numbered; each city's neighbours are a list sorted by distance, cut into
chunks of ``CHUNK``.  An open request is one row: its city, the bits of the
cities it has seen and a cursor, the chunk of the list it looks at next.  A hop joins it to that
one chunk by (city, chunk) and takes the first neighbour whose bit is not set;
a chunk without one moves the cursor on, the last chunk without one is a dead
end.  So a hop has one row per request, whatever the cities' out-degree, and no
aggregate.  Requests are rows: repeated or NULL request ids stay apart.

After every ``HOPS`` hops the rows are written to a folder of their own below
``spark.checkpoint.dir``: the next step reads the open ones, the result reads
the finished ones of all steps in one scan, and a lost executor recomputes one
step only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordinals import with_ordinal
from tessera.session import cut_lineage, scratch_dir

HOPS = 4  # hops between two written steps
CHUNK = 64  # neighbours per list chunk
_WORD = 64  # bits of one element of the visited set


def edges_from_matrix(matrix: DataFrame, key: str = "city", exclude: Sequence[str] = ()) -> DataFrame:
    """RSH4: wide matrix → edges, excluded cities removed on both axes."""
    from tessera.operators.reshape import matrix_to_edges
    return matrix_to_edges(matrix, key, exclude)


def neighbour_lists(edges: DataFrame, numbers: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(from_no, chunk_no, last, items)``: each city's neighbours by (km, ord), ``chunk`` per row.

    Places come from the global order of all edges, so a city with many
    neighbours is not one task's work.
    """
    to = numbers.select(F.col("city").alias("dst"), F.col("no").alias("to_no"))
    from_ = numbers.select(F.col("city").alias("src"), F.col("no").alias("from_no"))
    ways = edges.join(from_, "src").join(to, "dst").select("from_no", "to_no", "dst", "km", "ord")
    placed = with_ordinal(ways, ["from_no", "km", "ord", "to_no"], "place")
    starts = placed.groupBy(F.col("from_no").alias("_f")).agg(F.min("place").alias("_first"), F.count("*").alias("_n"))
    at = F.col("place") - F.col("_first")
    return (placed.join(starts, F.col("from_no") == F.col("_f"))
            .withColumns({"at": at, "chunk_no": F.floor(at / chunk)})
            .groupBy("from_no", "chunk_no").agg(
                F.max(F.col("at") == F.col("_n") - 1).alias("last"),
                F.sort_array(F.collect_list(F.struct("at", "to_no", "dst", "km"))).alias("items")))  # at most ``chunk``


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(_WORD)).cast("int"))


def _word(number: Column) -> Column:
    return F.floor(number / _WORD).cast("int")


def _seen(words: Column, number: Column) -> Column:
    return F.get(words, _word(number)).bitwiseAND(_bit(number)) != 0


def _mark(words: Column, number: Column) -> Column:
    return F.transform(words, lambda w, i: F.when(i == _word(number), w.bitwiseOR(_bit(number))).otherwise(w))


_STATE = ("row", "req_id", "origin", "destination", "cur", "cursor", "seen", "route", "total_km", "status")


def _hops(lists: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A hop over ``lists``: every open request looks at one chunk; others stay as they are.

    The expressions are made once and serve every hop.
    """
    items = lists.select(F.col("from_no").alias("_from"), F.col("chunk_no").alias("_chunk"), "last", "items")
    meets = (F.col("cur") == F.col("_from")) & (F.col("cursor") == F.col("_chunk")) & (F.col("status") == "open")
    pick = F.get(F.filter("items", lambda x: ~_seen(F.col("seen"), x["to_no"])), F.lit(0))
    found, going = F.col("pick").isNotNull(), F.col("status") == "open"
    after = [
        "row", "req_id", "origin", "destination",
        F.when(found, F.col("pick.to_no")).otherwise(F.col("cur")).alias("cur"),
        F.when(found, 0).otherwise(F.col("cursor") + 1).cast("bigint").alias("cursor"),
        F.when(found, _mark(F.col("seen"), F.col("pick.to_no"))).otherwise(F.col("seen")).alias("seen"),
        F.when(found, F.array_append("route", F.col("pick.dst"))).otherwise(F.col("route")).alias("route"),
        (F.col("total_km") + F.coalesce("pick.km", F.lit(0.0))).alias("total_km"),
        F.when(going & found & (F.col("pick.dst") == F.col("destination")), F.lit("arrived"))
        .when(going & ~found & F.coalesce("last", F.lit(True)), F.lit("dead")).otherwise(F.col("status")).alias("status")]
    return lambda state: state.join(items, meets, "left").withColumn("pick", pick).select(*after)


def greedy_routes(requests: DataFrame, edges: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Route every row ``(req_id, origin, destination)`` greedily; each request is in the result once.

    ``edges``: ``(src, dst, km, ord)``; ``ord`` breaks distance ties (first
    column of the matrix wins, like ``idxmin``).  NULL distances and the
    diagonal are never taken, but their cities are known: one without usable
    distances is a dead end, and a route from a known city to itself has
    length 0.  Output per request: ``route`` (array of cities), ``total_km``,
    ``steps`` and ``error`` (unknown city / dead end).
    """
    spark = requests.sparkSession
    table = cut_lineage(edges.select("src", "dst", F.col("km").cast("double").alias("km"), "ord"), "route-edges")
    names = table.select(F.col("src").alias("city")).union(table.select("dst")).where("city is not null").distinct()
    numbers = cut_lineage(with_ordinal(names, ["city"], "no"), "route-cities")
    ways = table.where(F.col("km").isNotNull() & (F.col("src") != F.col("dst")))
    lists = cut_lineage(neighbour_lists(ways, numbers, chunk), "route-lists")
    words = numbers.count() // _WORD + 1
    root = scratch_dir(spark, "route-steps")

    ends = [numbers.select(F.col("city").alias(f"_{c}"), F.col("no").alias(f"_{c}_no")) for c in ("a", "b")]
    r = requests.select(F.monotonically_increasing_id().alias("row"), "req_id", "origin", "destination")
    known = r.join(ends[0], F.col("origin") == F.col("_a"), "left").join(ends[1], F.col("destination") == F.col("_b"), "left")
    nothing = F.array_repeat(F.lit(0).cast("bigint"), words)
    state = known.select(
        "row", "req_id", "origin", "destination", F.col("_a_no").alias("cur"), F.lit(0).cast("bigint").alias("cursor"),
        F.when(F.col("_a_no").isNotNull(), _mark(nothing, F.col("_a_no"))).alias("seen"), F.array("origin").alias("route"),
        F.lit(0.0).alias("total_km"),
        F.when(F.col("_a").isNull() | F.col("_b").isNull(), F.lit("unknown"))
        .when(F.col("origin") == F.col("destination"), F.lit("arrived")).otherwise(F.lit("open")).alias("status"))
    hop = _hops(lists)
    step = 0
    while True:  # ends: every hop adds a city to each open route, moves its cursor on, or closes it
        state.select(*_STATE).write.parquet(f"{root}/step={step}")
        state = spark.read.schema(state.schema).parquet(f"{root}/step={step}").where("status = 'open'")
        if state.isEmpty():
            break
        for _ in range(HOPS):
            state = hop(state)
        step += 1
    done = spark.read.schema(state.schema).parquet(root).where("status != 'open'")
    lost = F.col("status") == "unknown"
    return done.select(
        "req_id", "origin", "destination", F.when(~lost, F.col("route")).alias("route"),
        F.when(~lost, F.col("total_km")).alias("total_km"),
        F.when(lost, F.lit("unknown city")).when(F.col("status") == "dead", F.lit("dead end")).alias("error"),
    ).withColumn("steps", F.array_size("route") - 1)
