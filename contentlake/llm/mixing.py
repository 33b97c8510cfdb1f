"""Mix sources to target weights by min-cost flow over membership patterns.

Documents are counted by the set of sources they belong to. Each source sends its quota of
words to patterns that hold it; the first use of a pattern's words is free, each further
use costs more, so the flow repeats as little as the quotas allow. What a pattern receives
is then taken from its documents in seeded order: whole rounds for all, and the rest of it
from each document in turn that still fits. What stays open is smaller than every document
that was not taken; the document, or further copy of one, that brings the sum nearest is added
as long as one brings it nearer.

Only counts travel to the driver and to all tasks: a row per source and per pattern. Patterns are
as many as distinct source sets, bounded by `max_patterns` (more raise an error, none are cut).

Defined cases: a null source is a source of its own, last in order; a null or wordless
text has size 0 and is never taken; rows with equal ids are separate documents, ties in
seeded order fall to the id and then the size; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentlake.llm.common import free_name, numbered, staged, word_count

WEIGHTS = (5, 2, 1)
REPEATS = 3
_BUCKETS = 4096


def quotas(sizes: dict, weights: dict, total: int, limit: int = REPEATS) -> dict:
    """Shares of `total` words by weight; none above limit x size, the excess reshared."""
    left, open_to, out = float(total), dict(weights), {}
    while open_to:
        of = sum(open_to.values())
        full = [s for s, w in open_to.items() if left * w / of > limit * sizes[s]]
        if not full:
            return out | {s: left * w / of for s, w in open_to.items()}
        for s in full:
            out[s] = float(limit * sizes[s])
            open_to.pop(s)
        left -= sum(out[s] for s in full)
    return out


def route(need: dict, patterns: dict[tuple, int], repeats: int = REPEATS) -> dict[tuple, int]:
    """Words taken from each pattern by min-cost flow, the k-th use of its words costing 2^k - 1.

    Only the step from a pattern to the sink has a price, and no path passes the sink, so a cheapest
    path costs what its last step costs. The uses are therefore opened by price, `repeats` times, and each
    time the flow is made as large as it gets, by blocking flows over shortest paths.

    need: words per source; patterns: words per source set. Integers throughout.
    """
    number = {s: i for i, s in enumerate(need)}
    members = [[number[s] for s in p] for p in patterns]
    holding: list[list[int]] = [[] for _ in need]
    for j, of in enumerate(members):
        for i in of:
            holding[i].append(j)
    left, room = list(need.values()), [0] * len(members)
    sent = [dict.fromkeys(of, 0) for of in members]
    for _ in range(repeats):
        room = [r + words for r, words in zip(room, patterns.values())]
        while _blocking_flow(left, room, sent, members, holding):
            pass
    return {p: sum(by_source.values()) for p, by_source in zip(patterns, sent)}


def _layers(left: list, room: list, sent: list[dict], holding: list[list]) -> tuple[dict, dict, bool]:
    """Steps from a source with words left to each source and pattern, and if a pattern with room was met."""
    to_source, to_set = {i: 0 for i, words in enumerate(left) if words}, {}
    now, step = list(to_source), 0
    while now:
        met = []
        for i in now:
            for j in holding[i]:
                if j not in to_set:
                    to_set[j] = step + 1
                    met.append(j)
        if any(room[j] for j in met):
            return to_source, to_set, True
        now, step = [], step + 2
        for j in met:
            for i, words in sent[j].items():
                if words and i not in to_source:
                    to_source[i] = step
                    now.append(i)
    return to_source, to_set, False


def _blocking_flow(left: list, room: list, sent: list[dict], members: list[list], holding: list[list]) -> bool:
    """Fills all shortest paths from sources with words left to patterns with room; False if there are none.

    A path is source, pattern, source, ...: what a pattern already has from the next source gives way.
    """
    to_source, to_set, found = _layers(left, room, sent, holding)
    if not found:
        return False
    tried_sets, tried_sources = dict.fromkeys(to_source, 0), dict.fromkeys(to_set, 0)
    for start in [i for i in to_source if left[i]]:
        path = [start]
        while path and left[start]:
            x = path[-1]
            if len(path) % 2:
                at, ahead = tried_sets[x], holding[x]
                if at < len(ahead) and to_set.get(ahead[at]) == to_source[x] + 1:
                    path.append(ahead[at])
                elif at < len(ahead):
                    tried_sets[x] += 1
                else:
                    path.pop()
                    if path:
                        tried_sources[path[-1]] += 1
            elif room[x]:
                takes = list(zip(path[1::2], path[0::2]))
                gives = list(zip(path[1::2], path[2::2]))
                push = min(left[start], room[x], *[sent[j][i] for j, i in gives])
                left[start] -= push
                room[x] -= push
                for j, i in takes:
                    sent[j][i] += push
                for j, i in gives:
                    sent[j][i] -= push
                path = [start]
            else:
                at, ahead = tried_sources[x], members[x]
                if at < len(ahead) and sent[x][ahead[at]] and to_source.get(ahead[at]) == to_set[x] + 1:
                    path.append(ahead[at])
                elif at < len(ahead):
                    tried_sources[x] += 1
                else:
                    path.pop()
                    tried_sets[path[-1]] += 1
    return True


def _order(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("id"), F.col("size"))


def _seeded(members: DataFrame, rest: DataFrame, seed: int) -> DataFrame:
    """(row) of the documents taken for `rest` (pattern, rest): in seeded order, each that still fits.

    Documents are cut into hash ranges that are counted first; only the range in which the
    sum is reached is ordered row by row. Those larger than the gap that is left are set aside,
    and the others are counted anew, until none fits. A round ends at a document that fits
    alone but not behind the others, so the gap falls below its size.
    """
    ranged = staged(
        members.join(F.broadcast(rest), "pattern")
        .where("size > 0 and size <= rest")
        .select("id", "row", "size", "pattern", _order(seed).alias("o"))
        .withColumn("range", F.pmod(F.shiftrightunsigned("o", 40), F.lit(_BUCKETS)).cast("int")),
        "ranged",
    )
    chosen = ranged.select("row", "size", "pattern").limit(0)
    before = Window.partitionBy("pattern").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("pattern", "range").orderBy("o", "id", "row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    while True:
        taken = chosen.groupBy("pattern").agg(F.sum("size").alias("sum"))
        gap = rest.join(taken, "pattern", "left").select(
            "pattern", (F.col("rest") - F.coalesce("sum", F.lit(0))).alias("gap")
        )
        fitting = ranged.join(F.broadcast(gap), "pattern").where("size <= gap").join(chosen.select("row"), "row", "left_anti")
        counted = fitting.groupBy("pattern", "range").agg(F.sum("size").alias("words"))
        ranges = counted.select(
            "pattern", "range", "words", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("below")
        )
        placed = fitting.join(ranges, ["pattern", "range"])
        whole = placed.where("below + words <= gap").select("row", "size", "pattern")
        cut = (
            placed.where("below < gap and below + words > gap")
            .withColumn("sum", F.col("below") + F.sum("size").over(inside))
            .where("sum <= gap")
            .select("row", "size", "pattern")
        )
        more = staged(whole.union(cut), "chosen")
        if more.isEmpty():
            return chosen.select("row")
        chosen = chosen.union(more)


def _nearest(placed: DataFrame, repeats: int) -> DataFrame:
    """(row, more): further copies of rows of `placed` (row, size, pattern, got, copies) that bring the
    sum of their pattern nearer to `got`, one at a time, the nearest first."""
    open_to = placed.where("size > 0").select("row", "size", "pattern", "got", "copies")
    words = open_to.groupBy("pattern").agg(F.max("got").alias("got"), F.sum(F.col("size") * F.col("copies")).alias("taken"))
    gap = staged(words.select("pattern", (F.col("got") - F.col("taken")).alias("gap")).where("gap > 0"), "gap")
    more = placed.select("row").limit(0).withColumn("more", F.lit(0))
    while True:
        far = F.abs(F.col("size") - F.col("gap"))
        # As many rows of `more` as patterns at most, times the few rounds.
        now = open_to.join(F.broadcast(gap), "pattern").join(F.broadcast(more), "row", "left")
        usable = now.where((F.col("copies") + F.coalesce("more", F.lit(0)) < repeats) & (far < F.col("gap")))
        best = usable.groupBy("pattern").agg(F.min(F.struct(far.alias("far"), "row", "size")).alias("best"), F.max("gap").alias("gap"))
        best = staged(best.select("pattern", "best.row", (F.col("gap") - F.col("best.size")).alias("gap")), "nearest")
        if best.isEmpty():
            return more
        more = staged(more.union(best.select("row", F.lit(1))).groupBy("row").agg(F.sum("more").cast("int").alias("more")), "more")
        gap = best.select("pattern", "gap").where("gap > 0")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    seed: int = 42,
    max_patterns: int = 100_000,
    row_col: str | None = None,
) -> DataFrame:
    """(id, row, size, sources, source_size, target, copies) for every row of `docs`.

    source: a string column, or an array of strings for documents in several sources; by
    default the column `source`. source_size and target are those of the first source.
    row_col: a column that numbers the rows, if there is one.
    """
    src = F.col("source") if source is None else source
    kind = docs.select(src.alias("s")).schema["s"].dataType.typeName()
    sets = F.array(src) if kind != "array" else F.coalesce(src, F.array(F.lit(None).cast("string")))
    members = staged(
        docs.select(
            F.col(id_col).alias("id"),
            (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
            word_count(F.col(text_col)).alias("size"),
            # Null stands last in an ascending sort_array once the others carry a mark.
            F.array_sort(F.array_distinct(sets)).alias("sources"),
        ).withColumn("pattern", F.xxhash64(F.size("sources"), "sources")),
        "members",
    )
    found = members.groupBy("pattern", "sources").agg(F.sum("size").alias("words"))
    rows = found.limit(max_patterns + 1).collect()
    if len(rows) > max_patterns:
        raise ValueError(f"more than {max_patterns} distinct source sets")
    rows.sort(key=lambda r: [(s is None, s or "") for s in r["sources"]])  # of equal flows, the same one each time
    names = sorted({s for r in rows for s in r["sources"]}, key=lambda s: (s is None, s or ""))
    sizes = dict.fromkeys(names, 0)
    for r in rows:
        for s in r["sources"]:
            sizes[s] += r["words"]
    all_words = sum(r["words"] for r in rows)
    ranked = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    share = quotas(sizes, ranked, all_words, repeats)
    flow = route({s: round(t) for s, t in share.items()}, {tuple(r["sources"]): r["words"] for r in rows}, repeats)
    spark = docs.sparkSession
    plan = []
    for r in rows:
        got, words = flow[tuple(r["sources"])], r["words"]
        rounds = got // words if words else 0
        first = r["sources"][0] if r["sources"] else None
        plan.append(
            (r["pattern"], int(got), int(rounds), int(got - rounds * words), sizes.get(first, 0), float(share.get(first, 0.0)))
        )
    by_pattern = spark.createDataFrame(
        plan, "pattern long, got long, rounds int, rest long, source_size long, target double"
    )
    extra = _seeded(members, by_pattern.select("pattern", "rest"), seed).withColumn("one", F.lit(1))
    copies = F.when(F.col("size") > 0, F.col("rounds") + F.coalesce("one", F.lit(0))).otherwise(0)
    placed = staged(
        members.join(F.broadcast(by_pattern), "pattern").join(extra, "row", "left").withColumn("copies", copies), "placed"
    )
    more = F.broadcast(_nearest(placed, repeats))
    return placed.join(more, "row", "left").select(
        "id",
        "row",
        "size",
        "sources",
        "source_size",
        "target",
        (F.col("copies") + F.coalesce("more", F.lit(0))).alias("copies"),
    )


def repeat_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """`docs` with each row as often as the mix takes it, columns as they were."""
    rows, row_col = numbered(docs)
    counted = mix(rows, id_col, text_col, row_col=row_col, **how).where("copies > 0")
    times = counted.select("row", "copies")
    kept = rows.join(times, rows[row_col] == times["row"])
    copies = F.explode(F.sequence(F.lit(1), times["copies"])).alias(free_name(docs, "_copy"))
    return kept.select(*[rows[c] for c in docs.columns], copies).select(*docs.columns)
