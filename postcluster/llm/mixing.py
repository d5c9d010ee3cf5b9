"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

1. **Targets.**  Sources weigh ``WEIGHTS`` in turn, by their order.  A source
   gets ``min(MOST * its size, rate * its weight)`` words; the one rate at
   which all targets add up to all words is found by sharing the excess of the
   full sources anew until none is above its limit.
2. **Epochs.**  A target of 2.4 times the source is two complete epochs of
   every document, then a fraction of one.
3. **Fraction.**  Every document draws an exponential key
   ``-ln(u) / quality`` from a hash of its id; in the order of these keys a
   source's documents are a weighted sample without replacement at any length.
   Prefix sums of their sizes say where the budget ends.  The document at the
   end is cut there: so many of its first words are taken.

**Scale.**  No source is ever sorted whole.  Sizes are first added up in
``BINS`` ranges of the keys (partly before the shuffle); only the documents of
the one range where the budget ends are sorted, and documents with one key
there are one row first.  The sources' table is joined by source and one of
``SALTS`` numbers, so the documents of a large source are spread over tasks.
Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postcluster.llm.frames import ROW, cut

#: Weights of the sources, in their order, repeating.
WEIGHTS = (5, 2, 1)
#: A source is taken so many times at most.
MOST = 3
#: Ranges of the keys in which sizes are added up.
BINS = 4096
#: Tasks that a source's documents are spread over in joins with the sources.
SALTS = 64
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def uniform(*parts: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from a hash of the parts: 52 bits of md5."""
    text = F.concat_ws(":", F.lit(seed), *parts)
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def numbered_sources(sources: DataFrame) -> DataFrame:
    """``source, number`` in the order of code points, null last, from 0,
    without bringing the sources together: they are sorted over tasks, and
    only the tasks' counts meet."""
    ordered = cut(sources.select("source").orderBy(F.col("source").asc_nulls_last()).select(
        "source", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at")))
    counts = {r.task: r.n for r in ordered.groupBy("task").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for task in sorted(counts):
        before += [F.lit(task), F.lit(total)]
        total += counts[task]
    if not before:
        return ordered.select("source", F.lit(0).cast("long").alias("number"))
    return ordered.select("source", (F.create_map(*before)[F.col("task")].cast("long")
                                     + F.col("at").bitwiseAND((1 << 33) - 1)).alias("number"))


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Each round adds up, over the sources that are not full at the rate so far,
    what is left to share and the weights it is shared by: one row a round.
    """
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.col("number") % len(weights) + 1).cast("int"))
    numbered = numbered_sources(sources).select("source", turn.alias("weight"))
    weighed = cut(sources.join(numbered, sources["source"].eqNullSafe(numbered["source"])).select(
        sources["source"], "source_size", "weight"))
    total, rate = weighed.agg(F.sum("source_size")).first()[0] or 0, 0.0
    while True:
        full = F.lit(rate) * F.col("weight") > most * F.col("source_size")
        spent, open_weight = weighed.agg(
            F.sum(F.when(full, most * F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))).first()
        after = (total - (spent or 0)) / open_weight if open_weight else rate
        if after <= rate:
            break
        rate = after
    target = F.least(F.lit(rate) * F.col("weight"), (most * F.col("source_size")).cast("double"))
    return weighed.select("source", "source_size", target.alias("target"))


def _of_sources(rows: DataFrame, sources: DataFrame, how: str = "inner") -> DataFrame:
    """Documents (``source, name``) with their source's row (``of``, null safe)."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(SALTS)))
    each = sources.withColumn("of_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(each, F.col("source").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt")), how)


def mix_sources(df: DataFrame, quality: DataFrame | None = None, text: str = "text", source: str = "source",
                id_col: str = "doc_id", weights: tuple[float, ...] = WEIGHTS, most: int = MOST,
                keep: list[str] | None = None, bins: int = BINS, seed: str = SEED) -> DataFrame:
    """Kept columns (struct ``_row``) with ``size`` (words), ``source_size``,
    ``target`` (of the source), ``epochs`` (complete copies taken), ``part``
    (words of the last, incomplete copy) and ``taken`` (all words taken).

    ``quality`` (``id_col, quality``) weighs a document's chance in the
    fraction: an id without a row, null, negative and not finite weights count
    as 1, documents of 0 come last, and of an id's weights the largest holds.
    Null and empty texts have size 0 and add nothing.  Rows with one id and
    size in a source draw one key; if the budget ends among them, they share
    what is left evenly, a remainder of less than a word a row unused.  A null
    id draws by the text's hash.  A null source is a source.  Reruns, and
    other layouts of the table, agree.
    """
    words = F.col(f"`{text}`").cast("string")
    doc = F.col(f"`{id_col}`").cast("string")
    sized = df.select(
        F.struct(*[F.col(f"`{c}`") for c in (keep or df.columns)]).alias(ROW),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.coalesce(F.regexp_count(words, F.lit(WORD)).cast("long"), F.lit(0).cast("long")).alias("size"),
        F.coalesce(doc, F.concat(F.lit("text "), F.coalesce(F.md5(words), F.lit("")))).alias("name"))
    weight = F.lit(1.0)
    if quality is not None:  # ids and weights meet the sizes, never the texts
        value = F.col("quality").cast("double")
        fine = quality.where((value >= 0) & (value < float("inf")))
        best = fine.groupBy(F.col(f"`{id_col}`").cast("string").alias("id")).agg(F.max(value).alias("weight"))
        sized = sized.join(best, F.col("name") == F.col("id"), "left")
        weight = F.coalesce("weight", weight)
    u = uniform(F.col("name"), seed=seed)
    # Documents of quality 0 have no exponential key; behind all others, they come by their draw.
    rows = cut(sized.select(ROW, "source", "size", "name", (weight <= 0).alias("late"),
                            F.when(weight > 0, -F.log(u) / weight).otherwise(u).alias("key")))
    by_source = cut(rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.avg(F.when(~F.col("late"), F.col("key"))).alias("mean")))
    aims = targets(by_source.select("source", "source_size"), weights, most)
    budget = F.floor(F.col("target") + 0.5)
    means = by_source.select(F.col("source").alias("of"), F.coalesce("mean", F.lit(1.0)).alias("mean"))
    aims = cut(
        aims.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0))
        .withColumn("left", budget - F.col("epochs") * F.col("source_size"))
        .join(means, F.col("source").eqNullSafe(F.col("of"))))
    ends = _ends(rows, aims, bins)
    known = aims.select("of", "source_size", "target", "epochs").join(
        ends, F.col("of").eqNullSafe(F.col("ends_in")), "left")
    place = F.struct("late", "key", "name", "size")
    part = (F.when(place < F.col("end"), F.col("size")).when(place == F.col("end"), F.col("end_words"))
            .otherwise(F.lit(0)).cast("long"))
    return _of_sources(rows, known, "left").select(
        ROW, "size", "source_size", "target", F.col("epochs").cast("long").alias("epochs"), part.alias("part"),
    ).withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))


def _ends(rows: DataFrame, aims: DataFrame, bins: int) -> DataFrame:
    """For each source with a fraction: ``ends_in`` (the source), ``end`` (the
    last place that it takes from) and ``end_words`` (words taken of a row there)."""
    some = aims.where("left > 0").select("of", "left", "mean")
    early = F.least(F.floor((1 - F.exp(-F.col("key") / F.col("mean"))) * bins), F.lit(bins - 1))
    bin_ = F.when(F.col("late"), bins + F.floor(F.col("key") * bins)).otherwise(early).cast("long")
    placed = _of_sources(rows.where("size > 0"), some).select(
        "source", "left", bin_.alias("bin"), "late", "key", "name", "size")
    sums = placed.groupBy("source", "left", "bin").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bin")) - F.col("words")
    last = cut(sums.withColumn("before", before).where("before < left AND before + words >= left").select(
        F.col("source").alias("ends_in"), F.col("bin").alias("end_bin"), "before"))
    alike = placed.join(last, F.col("source").eqNullSafe(F.col("ends_in")) & (F.col("bin") == F.col("end_bin"))).groupBy(
        "source", "left", "before", "late", "key", "name", "size").agg(F.count("*").alias("rows"))
    here = F.col("size") * F.col("rows")
    until = F.col("before") + F.sum(here).over(Window.partitionBy("source").orderBy("late", "key", "name", "size"))
    return cut(alike.withColumn("until", until).where((F.col("until") >= F.col("left")) & (F.col("until") - here < F.col("left"))).select(
        F.col("source").alias("ends_in"), F.struct("late", "key", "name", "size").alias("end"),
        F.floor((F.col("left") - F.col("until") + here) / F.col("rows")).alias("end_words")))


def mixed_texts(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: one row for each copy taken (``_row``, ``epoch`` from
    0, ``mixed_text``).  Of the incomplete copy, the words taken are joined by
    one space.  ``mixed`` must have kept the text."""
    whole = F.coalesce(F.col(f"{ROW}.`{text}`").cast("string"), F.lit(""))
    some = F.array_join(F.slice(F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)), 1, F.col("part").cast("int")), " ")
    copies = mixed.where("taken > 0").select("*", F.explode(F.expr("sequence(0L, epochs)")).alias("epoch"))
    return copies.where("epoch < epochs OR part > 0").select(ROW, "epoch", F.when(
        (F.col("epoch") < F.col("epochs")) | (F.col("part") == F.col("size")), whole).otherwise(some).alias("mixed_text"))
