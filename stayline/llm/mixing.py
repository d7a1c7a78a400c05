"""Mixing sources to target weights: capped water-filling and seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stayline.functions.hashing import md5_key
from stayline.operators.ranks import prefix_sums
from stayline.session import broadcast_if_small, materialize

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_HEX = 3  # 16 ** 3 seeded buckets, the grain of a fractional repetition
SMALL_ROWS = 100_000  # a table of sources up to this size is broadcast


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def weighted_sources(sizes: DataFrame, cycle=(5, 2, 1)) -> DataFrame:
    """Weights dealt in turn to the sources by code point, NULL last. `sizes`: source, source_size."""
    keyed = sizes.withColumns(
        {"_place": F.struct(F.col("source").isNull().alias("last"), "source"), "_one": F.lit(1)}
    )
    ranked = prefix_sums(keyed, "_place", ["_one"])
    turn = F.array(*[F.lit(w) for w in cycle])
    place = ((F.col("cum__one") - 1) % len(cycle)).cast("int")
    return ranked.select("source", "source_size", F.get(turn, place).cast("bigint").alias("weight"))


def fill(sources: DataFrame, share: tuple[int, int], cap: int) -> DataFrame:
    """Water-filling. Each source gets weight x level, at most cap x its size; the level is raised
    until all shares together make `share` (numerator, denominator) of all sizes.

    Sources above their cap are clamped and the rest shares what they leave, until none is above.
    Each round is one aggregate over the table of sources; the level only rises, so the rounds end.
    Adds `target double` and the exact fraction `num / den` behind it.
    """
    wide = "decimal(38,0)"
    up, down = share
    level_num, level_den = 0, 1
    clamped = None
    while True:
        above = F.col("weight").cast(wide) * F.lit(level_num).cast(wide) > F.col("source_size").cast(wide) * F.lit(
            cap * level_den
        ).cast(wide)
        row = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, F.col("source_size"))).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        total, held, weights = row["all"] or 0, row["held"] or 0, row["open"] or 0
        if row["n"] == clamped or not weights:
            break
        clamped = row["n"]
        level_num, level_den = max(0, up * total - down * cap * held), down * weights
    num = F.when(above, F.col("source_size") * cap).otherwise(F.col("weight") * F.lit(level_num))
    den = F.when(above, F.lit(1)).otherwise(F.lit(level_den)).cast("bigint")
    both = sources.withColumns({"num": num.cast("bigint"), "den": den})
    return both.withColumn("target", F.col("num").cast("double") / F.col("den").cast("double"))


def mix(
    docs: DataFrame,
    seed: int = 9,
    cycle=(5, 2, 1),
    share: tuple[int, int] = (3, 2),
    cap: int = 2,
    whole_texts: bool = False,
) -> DataFrame:
    """Each row of `docs` with size, source_size, target, whole, part and taken (words).

    A source with target t and size s takes every text floor(t / s) times in full. What is left of
    t is one more repetition of a share of the source: texts lie in 4,096 seeded buckets by md5 of
    the doc_id; those before the bucket in which the rest runs out are taken once more, those in it
    give the same fraction of their words (`part`, the first words of the text), later ones none.
    So a source's words miss its target by less than a word per text of one bucket, reruns agree, and
    no rows are sorted or moved: the texts meet a table of sources, whatever share one of them has.

    With `whole_texts` no text is cut: the bucket in which the rest runs out is put in a seeded order (by the
    doc_id, then by the whole row), and its texts are taken in full as long as they fit into the rest, so a source's
    words miss its target by less than one text. Texts with a NULL doc_id lie in buckets by md5 of the text then.

    NULL and empty texts have size 0 and are taken 0 words; a NULL source is a source of its own;
    rows with a NULL or repeated doc_id share a bucket; repeated rows are all counted. An empty table
    gives an empty result. Columns of `docs` with these names are replaced.
    """
    key = F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit("")))
    unnamed = F.coalesce(md5_key(seed, "text"), F.lit("000")) if whole_texts else F.lit("000")
    bucket = F.substring(F.coalesce(md5_key(seed, "doc_id"), unnamed), 1, BUCKET_HEX)
    sized = docs.withColumns({"size": word_count("text"), "_bucket": bucket, "_key": key})
    grains = materialize(
        sized.groupBy("_key", "_bucket", "source").agg(F.sum("size").alias("words")), "mix-buckets"
    )
    sizes = grains.groupBy("_key", "source").agg(F.sum("words").alias("source_size"))
    filled = fill(materialize(weighted_sources(sizes, cycle), "mix-sources"), share, cap)
    whole = F.when(F.col("source_size") > 0, F.expr("num div (den * source_size)")).otherwise(F.lit(0)).cast("bigint")
    plan = filled.withColumns({"_key": key, "whole": whole})
    plan = plan.withColumn("_rest", F.round("target").cast("bigint") - F.col("whole") * F.col("source_size"))
    # At most 4,096 buckets a source: a small window for each.
    upto = Window.partitionBy("_key").orderBy("_bucket")
    cut = (
        grains.drop("source")
        .join(plan.select("_key", "_rest"), "_key")
        .withColumn("_before", F.sum("words").over(upto) - F.col("words"))
        .filter((F.col("_before") <= F.col("_rest")) & (F.col("_before") + F.col("words") > F.col("_rest")))
        .groupBy("_key")
        .agg(F.max(F.struct("_bucket", "_before", "words")).alias("_cut"))
    )
    plan = materialize(
        plan.join(cut, "_key", "left").select(
            "_key", "source_size", "target", "whole",
            F.col("_cut._bucket").alias("_at"),
            (F.col("_rest") - F.col("_cut._before")).alias("_left"),
            F.col("_cut.words").alias("_words"),
        ),
        "mix-plan",
    )
    made = {"source_size", "target", "whole", "part", "taken"}
    base = sized.select(*[c for c in sized.columns if c not in made])
    joined = base.join(broadcast_if_small(plan, SMALL_ROWS), "_key", "left")
    here = F.coalesce(F.col("_bucket") == F.col("_at"), F.lit(False))
    if whole_texts:
        at_edge = F.coalesce("_part", F.lit(0))
        joined = joined.filter(~here).withColumn("_part", F.lit(None).cast("bigint")).unionByName(_fitting(joined.filter(here), seed))
    else:
        at_edge = F.expr("cast(size as decimal(38,0)) * _left div _words")
    part = (
        F.when(F.col("_at").isNull(), F.lit(0))  # nothing left after the whole repetitions
        .when(F.col("_bucket") < F.col("_at"), F.col("size"))
        .when(F.col("_bucket") == F.col("_at"), at_edge)
        .otherwise(F.lit(0))
        .cast("bigint")
    )
    return (
        joined.withColumn("part", part)
        .withColumn("taken", F.col("whole") * F.col("size") + F.col("part"))
        .drop("_key", "_bucket", "_at", "_left", "_words", "_part")
    )


def _fitting(edge: DataFrame, seed: int) -> DataFrame:
    """`edge` with _part: the size of a text that is taken in full, 0 of others."""
    row = F.to_json(F.struct(*[f"`{c}`" for c in edge.columns]))
    order = {"_row": md5_key(seed, "doc_id"), "_more": F.md5(F.concat(F.lit(f"{seed}:"), row)), "_tie": F.monotonically_increasing_id()}
    edge = materialize(edge.withColumns(order), "mix-edge")  # equal rows are told apart by _tie
    placed = edge.withColumn("_place", F.struct("_row", "_more", "_tie")).drop("_row", "_more", "_tie")
    ranked = prefix_sums(placed, "_place", ["size"], groups=["_key"])
    fits = F.when(F.col("cum_size") <= F.col("_left"), F.col("size")).otherwise(F.lit(0)).cast("bigint")
    return ranked.withColumn("_part", fits).drop("_place", "cum_size", "tot_size")


def sample(mixed: DataFrame) -> DataFrame:
    """The texts of a mix: each one `whole` times in full, and its first `part` words if it has a part.

    A part ends after its last word. Texts taken for no word, empty ones included, are left out;
    the rows of a text stand side by side and carry all its other columns.
    """
    n = F.col("part").cast("int")
    words = F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    first = F.rtrim(F.array_join(F.slice(words, F.lit(1), n), ""))
    last = F.when(n >= F.col("size"), F.array("text")).when(n > 0, F.array(first))
    copies = F.concat(
        F.array_repeat("text", F.col("whole").cast("int")), F.coalesce(last, F.array().cast("array<string>"))
    )
    return mixed.filter(F.col("taken") > 0).withColumn("text", F.explode(copies))
