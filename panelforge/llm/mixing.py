"""Mixing sources to target weights by highest quotients.

1. Every source's target is its weighted share of the budget, stopped at a
   maximum number of passes over the source; the excess goes to the others.
2. The documents of a source are dealt by a hash to streams of about
   ``STREAM_WORDS`` words, and the length of a stream is counted in blocks of
   ``BLOCK_WORDS`` words: the unit of the quotas, whatever the size of the corpus.
3. The blocks of the mix are apportioned over (source, stream): the highest
   quotients weight / (2 k + 1) win (Sainte-Lague), giving integer quotas.
   Quotients that are certain to win are counted, only those near the limit are
   listed and numbered over range partitions: about four per stream, not one per
   block.
4. A quota of more than all blocks takes the stream as often as it fits; the
   rest is taken from the stream's documents in the order of a seeded hash, whole
   ones until the quota is used up. Only the document in which it ends is cut:
   at most one in a stream, of which the first words are taken.

Every number depends on the data and the seed only, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import WORD, keeping_own, n_words, text_of, written
from panelforge.operators.ordered import row_numbers

#: Words of a stream, some hundreds of usual documents; at most one document of a stream is cut.
STREAM_WORDS = 50_000
#: Words of a block, the unit of the quotas.
BLOCK_WORDS = 16
ADDED = ("mix_size", "mix_source_size", "mix_target", "mix_passes", "mix_ranges", "mix_taken")


def source_key(source: Column) -> Column:
    """Sorts by code point with null last; never null itself."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def source_targets(sizes: DataFrame, weights: Sequence[float], budget: float, most: float) -> DataFrame:
    """(skey, source_size, weight, target) for ``sizes`` of (skey, source_size).

    One row per source. Sources are weighted in the order of ``skey``, the
    weights repeating. A source of size 0 has target 0.
    """
    placed = row_numbers(sizes, [], [F.col("skey").asc()], "__place")
    turns = F.array(*[F.lit(float(w)) for w in weights])
    table = written(placed.withColumn("weight", F.element_at(turns, (F.pmod(F.col("__place") - 1, F.lit(len(weights))) + 1).cast("int"))).drop("__place"), "mix-sources")
    cap = F.col("source_size") * F.lit(float(most))
    total = table.agg(F.sum("source_size").cast("double").alias("n")).first().n or 0.0
    level, stopped = 0.0, -1
    while True:  # words per unit of weight, raised as sources reach their stop
        full = cap <= F.col("weight") * F.lit(level)
        r = table.agg(
            F.sum(F.when(full, cap)).alias("taken"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
            F.count(F.when(full, 1)).alias("stopped"),
        ).first()
        if not r.weight or r.stopped == stopped:
            break
        stopped = r.stopped
        level = (budget * total - (r.taken or 0.0)) / r.weight
    return table.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def _quotas(streams: DataFrame, most: float) -> DataFrame:
    """Integer quotas of the streams (skey, part, blocks, share), share being the blocks wished for.

    No quota exceeds ``most`` times the blocks of its stream; a share never does, so that the bound takes
    no more than the rounding of a stream gave it.
    """
    t = streams.agg(F.sum("share").alias("share"), F.count("*").alias("parties")).first()
    seats = int(round(t.share or 0.0, 3) + 0.5)  # the last bits of a sum depend on the order of its rows
    slack = t.parties / (2.0 * seats) if seats else 0.0
    # the winning divisor lies within seats -+ parties / 2, so a party's seats lie in [low, high]
    low = F.greatest(F.lit(0), F.floor(F.col("share") * (1 - slack)) - 1)
    high = F.ceil(F.col("share") * (1 + slack)) + 1
    bounds = streams.withColumn("low", low.cast("long"))
    sure = bounds.agg(F.sum("low").alias("n")).first().n or 0
    listed = bounds.withColumn("k", F.explode(F.sequence("low", high.cast("long")))).withColumn("quotient", F.col("share") / (2 * F.col("k") + 1))
    order = [F.desc("quotient"), F.col("skey").asc(), F.col("part").asc(), F.col("k").asc()]
    won = (
        row_numbers(listed, [], order, "place").where(F.col("place") <= max(0, seats - sure))
        .groupBy("skey", "part").agg(F.count("*").alias("won"))
    )
    quota = F.least(F.col("low") + F.coalesce("won", F.lit(0)), F.floor(F.lit(float(most)) * F.col("blocks")))
    return bounds.join(won, ["skey", "part"], "left").withColumn("quota", quota.cast("long")).drop("low", "won")


def mix(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, most: float = 2.0, seed: int = 20,
    text: str = "text", doc_id: str = "doc_id", source: str = "source",
) -> DataFrame:
    """All rows and columns of ``docs`` plus what the mix takes of each.

    ``mix_size``: words of the text (null: 0); ``mix_source_size`` and
    ``mix_target``: those of its source; ``mix_passes``: how often the whole
    document is taken; ``mix_ranges``: word ranges [from, to) taken once more, of
    a document that is cut (at most one in a stream); ``mix_taken``: words taken in all. Documents without words take nothing.
    No stream is taken more than ``most`` times, no document more than ``most`` rounded up.
    A null source is a source, the last one. Repeated rows are documents of
    their own. An empty table gives an empty result. Columns of ``docs`` with the
    names of the added ones are replaced.
    """
    own = [c for c in docs.columns if c not in ADDED]
    sized = docs.select(*own).withColumns({
        "__skey": source_key(F.col(source)), "__hash": F.xxhash64(F.lit(seed), doc_id), "mix_size": n_words(text_of(text)),
    })
    words = written(sized.select(F.col("__skey").alias("skey"), F.col("__hash").alias("hash"), F.col("mix_size").alias("size")), "mix-words")
    targets = source_targets(words.groupBy("skey").agg(F.sum("size").alias("source_size")), weights, budget, most)
    targets = targets.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("source_size") / STREAM_WORDS)).cast("long"))
    lengths = (
        words.join(targets, "skey")
        .groupBy("skey", F.pmod("hash", "parts").alias("part")).agg(F.sum("size").alias("length"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    )
    blocks = F.greatest(F.lit(1), F.round(F.col("length") / BLOCK_WORDS)).cast("long")
    streams = lengths.where("length > 0").withColumn("blocks", blocks).withColumn("share", F.col("blocks") * F.col("target") / F.col("source_size"))
    rest = F.floor(F.pmod("quota", "blocks") * F.col("length") / F.col("blocks")).cast("long")
    quotas = _quotas(written(streams, "mix-streams"), most).select(
        F.col("skey").alias("__skey"), F.col("part").alias("__part"), F.floor(F.col("quota") / F.col("blocks")).alias("__passes"), rest.alias("__rest")
    )
    quotas = written(quotas, "mix-quotas")

    to_here = Window.partitionBy("__skey", "__part").orderBy(F.xxhash64(F.lit(seed + 1), doc_id), doc_id, F.xxhash64(text)).rowsBetween(Window.unboundedPreceding, 0)
    of_source = targets.select(F.col("skey").alias("__skey"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"), F.col("parts").alias("__parts"))
    size = F.col("mix_size")
    once_more = F.greatest(F.lit(0), F.least(size, F.coalesce("__rest", F.lit(0)) - (F.col("__end") - size)))
    whole = (F.col("__more") == size).cast("int")
    cut = (F.col("__more") > 0) & (F.col("__more") < size)
    ranges = F.when(cut, F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("__more").alias("to")))).otherwise(F.array().cast("array<struct<from:bigint,to:bigint>>"))
    return (
        sized.join(of_source, "__skey").withColumn("__part", F.pmod("__hash", "__parts"))
        .withColumn("__end", F.sum("mix_size").over(to_here))
        .join(quotas, ["__skey", "__part"], "left").withColumn("__more", once_more.cast("long"))
        .withColumn("mix_ranges", ranges)
        .withColumn("mix_passes", F.when(size > 0, F.coalesce("__passes", F.lit(0)) + whole).otherwise(0).cast("int"))
        .withColumn("mix_taken", F.when(size > 0, F.coalesce("__passes", F.lit(0)) * size + F.col("__more")).otherwise(0).cast("long"))
        .select(*own, *ADDED)
    )


def mixed_documents(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The documents of a mix, without the columns that ``mix`` added.

    A document stands once, unchanged, for each time the mix takes all of it; a
    partial take is a row with its ranges cut out of the text, with the blanks and
    line breaks before each of their words (of the first, if it begins the text).
    A length
    column ``n_chars`` is made to fit. Documents of which nothing is taken go.
    """
    own = [c for c in mixed.columns if c not in ADDED]
    blanks = " \t\n\x0b\f\r"
    words = F.regexp_extract_all(F.rtrim(text_of(text), F.lit(blanks)), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))

    def excerpt(w: Column) -> Column:
        def cut(r: Column) -> Column:
            taken = F.array_join(F.slice(w, (r["from"] + 1).cast("int"), (r["to"] - r["from"]).cast("int")), "")
            return F.when(r["from"] == 0, taken).otherwise(F.ltrim(taken, F.lit(blanks)))

        return F.array_join(F.transform("mix_ranges", cut), "\n")

    part = F.transform(F.array(words), excerpt)[0]  # the words are a variable of the outer function: made once, not for each range
    whole = F.array_repeat(F.col(text), F.col("mix_passes"))
    texts = F.when(F.size("mix_ranges") > 0, F.concat(whole, F.array(part))).otherwise(whole)
    out = mixed.withColumn(text, F.explode(texts))
    if "n_chars" in own:
        out = out.withColumn("n_chars", F.length(text).cast(mixed.schema["n_chars"].dataType))
    return out.select(*own)


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The documents as ``mix`` (with its ``options``) takes them, with their own columns whatever these are named."""
    text = options.get("text", "text")
    return keeping_own(docs, ADDED, lambda d: mixed_documents(mix(d, **options), text))
