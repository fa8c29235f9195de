"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sources, ordered by code point with null last, get the weights 5, 2, 1,
repeating, and share the size (words) of all documents. A target stops at three
times its source's size; what exceeds it is shared by the others by weight.

Every source is cut into blocks by a hash of doc_id and text, so the order of
blocks and of rows within them is a fixed permutation. A source gives whole
passes over all its blocks and then a prefix of the permutation that ends a few
documents short of the target. A row at the prefix's end that is larger than
what is still wanted is left out, and the prefix goes on over the rows behind it
that are no larger than that, again and again until a few such rows would do.
Only that last gap is filled by a bounded number of rows of each size class, so
that small sources come near their targets too. A prefix's end is found digit by
digit: each level sums sizes over at most 4096 cells a source and descends into
one of them, so no source is ever sorted or held in one task.

The block draws are dealt to output shards by a binary tree. Each node gives
half of its draws to either child; how many of each source go left is drawn
from the multivariate hypergeometric distribution (selection sampling, one
pseudo-random number a draw), so quotas are exact at every node and every shard
holds its share of every source. A shard then takes the next draws of each
source's permuted blocks: shards are disjoint and together take every draw. The
work at the root is one step per block draw, at most 4096 x 3 a source.

Defined results: a null text has size 0; sizes of 0 are never missed or needed;
an empty table gives an empty mix. Only hashes of doc_id and text decide what is
taken; a row's place in the input tells rows equal in both apart, so it decides
which of them is taken but never how many. The same input gives the same mix,
however its rows are split or ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import stored, word_count

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
DIGIT_BITS = 12  # 4096 cells a level
PER_CLASS = 16  # rows of each size class that may fill
RESERVE = 4  # mean sizes of a document that the prefix leaves to the rows that fill
LEVELS = 7  # five digits of the document, two of its place (for rows equal in doc_id and text)
LEAST_DEPTH, MOST_DEPTH = 5, 14  # 32 to 16,384 output shards
SHARD_DOCS = 20_000  # documents of a shard, between these bounds
MAX_PLAN_MB = 16  # a larger plan is joined by a shuffle with salt
SALT = 32


def _key(source: Column) -> Column:
    """Source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def sized(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Documents with working columns: key, size, digits and a row number."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    hashed = F.xxhash64(F.lit("mix"), name, F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")] if with_text else []),
        "doc_id",
        _key(F.col("source")).alias("key"),
        word_count(F.col("text")).alias("size"),
        hashed.alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    again = F.xxhash64(F.lit("row"), F.col("row"))
    mask = (1 << DIGIT_BITS) - 1
    digits = [F.shiftright("hash", DIGIT_BITS * i) for i in range(5)]
    digits += [again, F.shiftright(again, 20)]
    return rows.withColumn(
        "digits", F.array(*[d.bitwiseAND(F.lit(mask)).cast("int") for d in digits])
    )


def targets(sources: DataFrame) -> DataFrame:
    """Target size of each source; one row a source, so windows are small.

    Without limits a source would get weight x level. Sources whose limit lies
    lowest by limit / weight are the first that stop there; what remains for the
    others over their weights is the level, which grows until no other stops.
    """
    ordered = Window.orderBy(F.col("key") == "", "key")
    cyclic = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(ordered) - 1) % len(WEIGHTS) + 1)
    )
    weighed = sources.withColumn("weight", cyclic.cast("double")).withColumn(
        "limit", F.col("source_size").cast("double") * MOST_PASSES
    )
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "key")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    level = (
        F.sum(F.col("source_size").cast("double")).over(whole)
        - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    leveled = weighed.withColumn("level", level).withColumn(
        "free", F.col("level") * F.col("weight") <= F.col("limit")
    )
    final = F.max(F.when(F.col("free"), F.col("level"))).over(whole)
    return leveled.withColumn("target", F.least("limit", F.col("weight") * final)).select(
        "key", "source_size", "n_docs", "target"
    )


def _passes(planned: DataFrame) -> DataFrame:
    """Whole passes over the source and the words wanted beyond them."""
    passes = F.when(F.col("source_size") == 0, 0).otherwise(
        F.least(F.lit(MOST_PASSES), F.floor(F.col("target") / F.col("source_size")))
    )
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    bits = F.least(
        F.lit(DIGIT_BITS), F.floor(F.log2(F.greatest("n_docs", F.lit(1)).cast("double")))
    ).cast("int")
    reserve = F.least("rest", RESERVE * F.col("source_size") / F.greatest("n_docs", F.lit(1)))
    return (
        planned.withColumn("passes", passes.cast("int"))
        .withColumn("rest", F.when(F.col("passes") == MOST_PASSES, 0.0).otherwise(F.greatest(F.lit(0.0), rest)))
        .withColumn("reserve", reserve)
        .withColumn("rest", F.col("rest") - F.col("reserve"))
        .withColumn("block_bits", bits)
        .withColumn("cut", F.array().cast("array<int>"))
    )


def find_cuts(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Where a prefix of each source's ``rows`` ends: a list of digits, one a level.

    Rows whose digits come before ``cut`` are taken. ``rest`` becomes
    what is still wanted after the cells that are wanted whole.
    """
    by_source = Window.partitionBy("key").orderBy("digit")
    cells = None
    for level in range(LEVELS):
        path = F.slice("digits", 1, level) if level else F.array().cast("array<int>")
        if cells is None:
            inside = rows
        else:
            wanted = planned.where("rest > 0").select(F.col("key").alias("its_key"), "cut")
            inside = rows.join(wanted, (F.col("key") == F.col("its_key")) & (path == F.col("cut")))
        cells = inside.groupBy("key", F.element_at("digits", level + 1).alias("digit")).agg(
            F.sum("size").alias("cell_size"), F.count(F.lit(1)).alias("n")
        )
        summed = cells.withColumn(
            "upto", F.sum("cell_size").over(by_source.rowsBetween(Window.unboundedPreceding, 0))
        )
        # The prefix ends in the first cell that is not wanted whole.
        end = F.struct("digit", (F.col("upto") - F.col("cell_size")).alias("sum"), "n")
        ends = (
            summed.join(planned.where("rest > 0").select("key", "rest"), "key")
            .groupBy("key")
            .agg(F.min(F.when(F.col("upto") > F.col("rest"), end)).alias("end"), F.max("upto").alias("total"))
        )
        planned = stored(
            planned.join(ends, "key", "left")
            .withColumn(
                "cut",
                F.when(
                    F.col("rest") > 0,
                    F.concat("cut", F.array(F.coalesce(F.col("end.digit"), F.lit(1 << DIGIT_BITS)))),
                ).otherwise(F.col("cut")),
            )
            .withColumn("rest", F.greatest(F.lit(0.0), F.col("rest") - F.coalesce("end.sum", "total", F.lit(0))))
            .withColumn("n_end", F.coalesce("end.n", F.lit(0)))
            .drop("end", "total"),
            f"mix-cut{level}",
        )
        # A cell of one row needs no further digit.
        deeper = not planned.where("n_end > 1 AND rest > 0").isEmpty()
        planned = planned.drop("n_end")
        if not deeper:
            break
    return planned.withColumn("rest", F.col("rest") + F.col("reserve")).drop("reserve")


TAKEN = "exists(spans, s -> size <= s.cap AND digits >= s.since AND digits < s.cut)"


def take_prefixes(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``spans``: parts of the permutation of which all rows up to a size are taken.

    The first span is the prefix over all rows. While more is wanted than the
    class fill should find, another goes on from the row that was too large, over
    rows no larger than what is wanted. The first of them always fits, so each
    round takes rows, and what is wanted falls below the next row left out.
    """
    none = F.array().cast("array<int>")
    done = find_cuts(rows, planned)
    first = F.struct(F.lit((1 << 63) - 1).alias("cap"), none.alias("since"), F.col("cut").alias("cut"))
    done = done.withColumn(
        "spans", F.filter(F.array(first), lambda s: F.size(s["cut"]) > 0)
    )
    while True:
        wanted = F.broadcast if done.count() * 200 <= MAX_PLAN_MB << 20 else (lambda df: df)
        gap = done.where("rest > 0").select(F.col("key").alias("its_key"), F.col("cut").alias("since"), "rest")
        behind = rows.join(wanted(gap), F.col("key") == F.col("its_key")).where(
            "digits >= since AND size > 0 AND size <= rest"
        )
        left = behind.groupBy("key").agg(F.sum("size").alias("left_size"), F.count(F.lit(1)).alias("n_left"))
        reserve = F.least(F.col("rest"), RESERVE * F.col("left_size") / F.col("n_left"))
        more = stored(
            done.join(left.where(F.col("n_left") > PER_CLASS), "key")
            .where(F.col("rest") > 2 * reserve)
            .withColumn("reserve", reserve)
            .withColumn("rest", F.col("rest") - F.col("reserve"))
            .withColumn("since", F.col("cut"))
            .withColumn("cap", F.floor("rest"))
            .withColumn("cut", none)
            .drop("left_size", "n_left"),
            "mix-more",
        )
        if more.isEmpty():
            return done
        bounds = more.select(F.col("key").alias("its_key"), "since", "cap")
        small = rows.join(wanted(bounds), F.col("key") == F.col("its_key")).where(
            "digits >= since AND size > 0 AND size <= cap"
        )
        found = find_cuts(small.select(rows.columns), more)
        span = F.struct("cap", "since", "cut")
        found = found.withColumn("spans", F.concat("spans", F.array(span))).select(done.columns)
        done = stored(done.join(more.select("key"), "key", "left_anti").unionByName(found), "mix-spans")


def fill_gaps(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """``extra``: rows outside the spans that fill the last gap.

    Candidates are up to ``PER_CLASS`` rows of each size class (an eighth of an
    octave) of a source, the first by hash, so their number has a bound. From the largest down, each
    that fits is taken; at last one more if that comes closer to the target.
    """
    wanted = planned.where("rest > 0").select(F.col("key").alias("its_key"), "spans", "rest")
    behind = (
        rows.join(wanted, F.col("key") == F.col("its_key"))
        .where(~F.expr(TAKEN) & (F.abs(F.col("size") - F.col("rest")) < F.col("rest")))
        .withColumn("class", F.floor(8 * F.log2(F.col("size").cast("double"))))
    )
    first = F.row_number().over(Window.partitionBy("key", "class").orderBy("hash", "row"))
    classes = behind.select("key", "class", "size", "hash", "row").withColumn("n", first).where(F.col("n") <= PER_CLASS)
    listed = classes.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("size", "hash", "row")), asc=False).alias("found")
    )
    kind = "ARRAY<STRUCT<size: BIGINT, hash: BIGINT, row: BIGINT>>"
    fitted = F.expr(
        f"""aggregate(found, named_struct('left', rest, 'taken', CAST(array() AS {kind})),
            (s, c) -> IF(c.size <= s.left,
                named_struct('left', s.left - c.size, 'taken', array_append(s.taken, c)), s))"""
    )
    closer = F.expr(
        """array_min(transform(
            filter(array_except(found, fit.taken), c -> abs(c.size - fit.left) < fit.left),
            c -> named_struct('miss', abs(c.size - fit.left), 'c', c)))"""
    )
    chosen = F.concat(F.col("fit.taken"), F.when(F.col("more").isNotNull(), F.array("more.c")).otherwise(F.array().cast(kind)))
    none = F.array().cast("array<struct<hash:bigint,row:bigint>>")
    return (
        planned.join(listed, "key", "left")
        .withColumn("fit", fitted)
        .withColumn("more", closer)
        .withColumn("extra", F.coalesce(F.transform(chosen, lambda c: F.struct(c["hash"], c["row"])), none))
        .drop("found", "fit", "more")
    )


def deal(planned: DataFrame, depth: int) -> DataFrame:
    """The splitting tree: ``ends`` of each source's draws by shard.

    Shard i takes the draws [ends[i - 1], ends[i]) of the source.
    """
    blocks = F.expr("shiftleft(1, block_bits)")
    last = F.when(
        F.size("cut") > 0,
        F.least(blocks, F.expr(f"shiftright(cut[0], {DIGIT_BITS} - block_bits) + 1")),
    ).otherwise(F.lit(0))
    planned = planned.withColumn("whole_draws", (F.col("passes") * blocks + last).cast("long"))
    quotas = planned.select("key", (F.col("whole_draws") + F.size("extra")).alias("quota"))
    nodes = quotas.groupBy().agg(
        F.array_sort(F.collect_list(F.struct("key", "quota"))).alias("quotas")
    ).select(F.lit(0).cast("long").alias("node"), "quotas")

    for level in range(depth):
        total = "aggregate(quotas, 0L, (s, q) -> s + q.quota)"
        # state: draws not yet decided, places left on the left side, left quotas
        split = f"""
            aggregate(quotas,
                named_struct('open', {total}, 'room', {total} div 2, 'taken', CAST(array() AS ARRAY<BIGINT>)),
                (s, q) -> CASE WHEN q.quota = 0 THEN
                    named_struct('open', s.open, 'room', s.room, 'taken', concat(s.taken, array(0L)))
                ELSE aggregate(sequence(1L, q.quota),
                    named_struct('open', s.open, 'room', s.room, 'taken', s.taken, 'n', 0L),
                    (t, i) -> IF(pmod(xxhash64({level}, node, q.key, i), 9007199254740992L) / 9007199254740992D * t.open < t.room,
                        named_struct('open', t.open - 1, 'room', t.room - 1, 'taken', t.taken, 'n', t.n + 1),
                        named_struct('open', t.open - 1, 'room', t.room, 'taken', t.taken, 'n', t.n)),
                    t -> named_struct('open', t.open, 'room', t.room, 'taken', concat(t.taken, array(t.n))))
                END,
                s -> s.taken)"""
        halves = nodes.withColumn("l", F.expr(split))
        child = """transform(quotas, (q, i) -> named_struct('key', q.key, 'quota', {}))"""
        nodes = halves.select(
            F.explode(
                F.array(
                    F.struct((F.col("node") * 2).alias("node"), F.expr(child.format("l[i]")).alias("quotas")),
                    F.struct((F.col("node") * 2 + 1).alias("node"), F.expr(child.format("q.quota - l[i]")).alias("quotas")),
                )
            ).alias("half")
        ).select("half.*")
    ends = (
        nodes.select("node", F.explode("quotas").alias("q"))
        .groupBy("q.key")
        .agg(F.array_sort(F.collect_list(F.struct("node", "q.quota"))).alias("shares"))
        .select(
            "key",
            F.expr(
                """aggregate(shares, CAST(array() AS ARRAY<BIGINT>),
                    (s, x) -> concat(s, array(coalesce(try_element_at(s, -1), 0L) + x.quota)))"""
            ).alias("ends"),
        )
    )
    return planned.join(ends, "key")


def _with_plan(rows: DataFrame, plan: DataFrame, depth: int) -> DataFrame:
    """Join rows to their source's plan; broadcast only within MAX_PLAN_MB."""
    n_sources = plan.count()
    if n_sources * (200 + 16 * (1 << depth)) <= MAX_PLAN_MB << 20:
        return rows.join(F.broadcast(plan), "key")
    salted = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return (
        rows.withColumn("salt", F.pmod(F.col("row"), F.lit(SALT)).cast("int"))
        .join(salted, ["key", "salt"])
        .drop("salt")
    )


def depth_for(rows: DataFrame) -> int:
    """Depth of the tree: shards of about ``SHARD_DOCS`` documents."""
    shards = max(1, -(-rows.count() // SHARD_DOCS))
    return min(MOST_DEPTH, max(LEAST_DEPTH, (shards - 1).bit_length()))


def plan_of(rows: DataFrame, depth: int) -> DataFrame:
    """One row a source: target, passes, end of the last pass, shard ends."""
    sources = rows.groupBy("key").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    planned = stored(_passes(targets(sources)), "mix-targets")
    filled = stored(fill_gaps(rows, take_prefixes(rows, planned)), "mix-filled")
    return stored(deal(filled, depth), "mix-plan")


def with_shards(rows: DataFrame, plan: DataFrame, depth: int) -> DataFrame:
    """Rows with ``shards``: the output shard of each time the row is taken."""
    joined = _with_plan(rows, plan, depth)
    block = F.expr(f"shiftright(digits[0], {DIGIT_BITS} - block_bits)")
    blocks = F.expr("shiftleft(1, block_bits)")
    # Rows that fill the gap are the draws behind those of the blocks.
    filler = F.array_position("extra", F.struct("hash", "row"))
    once_more = F.expr(TAKEN) | (filler > 0)
    last_draw = F.when(filler > 0, F.col("whole_draws") + filler - 1).otherwise(
        F.expr("CAST(passes * blocks + block AS BIGINT)")
    )
    # Pass i permutes the blocks by an odd multiplier; the last pass keeps hash order.
    draws = """
        transform(
            IF(passes > 0, sequence(0, passes - 1), CAST(array() AS ARRAY<INT>)),
            i -> CAST(i * blocks + pmod(block * (2 * pmod(xxhash64(key, i, 'odd'), 2048) + 1)
                                        + xxhash64(key, i) % 4096, blocks) AS BIGINT))"""
    return (
        joined.withColumn("block", block)
        .withColumn("blocks", blocks)
        .withColumn("draws", F.expr(draws))
        .withColumn(
            "draws",
            F.when(
                once_more,
                F.concat("draws", F.array(last_draw)),
            ).otherwise(F.col("draws")),
        )
        .withColumn("shards", F.expr("transform(draws, d -> size(filter(ends, e -> e <= d)))"))
        .drop("block", "blocks", "draws")
    )


def mix(docs: DataFrame, depth: int | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken and shards of every document."""
    rows = stored(sized(docs), "mix-sizes")
    depth = depth_for(rows) if depth is None else depth
    return with_shards(rows, plan_of(rows, depth), depth).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("shards")).alias("taken"),
        "shards",
    )


def mixed(docs: DataFrame, depth: int | None = None) -> DataFrame:
    """The mix itself: documents with all columns, once for each time taken.

    Each shard is shuffled on its own; rows of one shard follow each other.
    Sizes and texts come from one stored table that carries the row numbers.
    """
    whole = stored(sized(docs, with_text=True), "mix-rows")
    sizes = whole.drop("whole")
    depth = depth_for(sizes) if depth is None else depth
    plan = plan_of(sizes, depth)
    rows = with_shards(whole, plan, depth)
    drawn = rows.select("whole", "hash", F.posexplode("shards").alias("time", "shard"))
    return (
        drawn.withColumn("place", F.xxhash64(F.lit("place"), "hash", "time"))
        .repartition("shard", F.pmod("place", F.lit(8)))
        .sortWithinPartitions("shard", "place")
        .select("whole.*")
    )
