"""Segments, cluster profiles and the profile cards built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.numeric import exact_sum, share
from stayline.functions.text import fixed, join_parts, tag
from stayline.schema import FEATURES_8, RISK_CHURN_LIMIT, RISK_HIGH, RISK_LOW


def segment() -> Column:
    return F.when((F.col("monthly_charges") > 250) & (F.col("num_products") >= 3), "PJ").otherwise("PF")


def add_segment(df: DataFrame) -> DataFrame:
    return df.withColumn("segmento", segment())


def segment_share(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        share(F.col("segmento") == "PF").alias("pf_pct"),
        share(F.col("segmento") == "PJ").alias("pj_pct"),
    )


def risk_label(rate: Column) -> Column:
    return F.when(rate >= RISK_CHURN_LIMIT, RISK_HIGH).otherwise(RISK_LOW)


def _mean(c: str) -> Column:
    return exact_sum(c) / F.count(c)


def profile_clusters(
    df: DataFrame, features=FEATURES_8, cluster: str = "cluster_id", label: str = "churn"
) -> DataFrame:
    """Per cluster: rows, churn rate, risk label, feature means."""
    stats = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.avg(F.col(label).cast("double")).alias("_rate"),
        *[F.bround(_mean(f), 3).alias(f"mean_{f}") for f in features],
    )
    return stats.select(
        cluster,
        "n_samples",
        F.bround("_rate", 4).alias("churn_rate"),
        risk_label(F.col("_rate")).alias("risk_label"),
        *[f"mean_{f}" for f in features],
    )


def segment_profiles(
    df: DataFrame, features=FEATURES_8, cluster: str = "cluster_id", with_all: bool = False
) -> DataFrame:
    """Per segment and cluster: rows, churn rate, risk, coverage of the segment, means.

    `with_all` adds the level without segments as segment ALL (grouping sets).
    """
    aggs = [
        F.count(F.lit(1)).alias("n_amostras"),
        F.avg(F.col("churn").cast("double")).alias("_rate"),
        *[F.bround(_mean(f), 3).alias(f"mean_{f}") for f in features],
    ]
    if with_all:
        seg, cl = F.col("segmento"), F.col(cluster)
        stats = (
            df.groupingSets([[seg, cl], [cl]], seg, cl)
            .agg(F.grouping_id().alias("_level"), *aggs)
            .withColumn("segmento", F.when(F.col("_level") > 0, "ALL").otherwise(seg))
            .drop("_level")
        )
    else:
        stats = df.groupBy("segmento", cluster).agg(*aggs)
    # One row per segment and cluster by now, so this window is tiny.
    of_segment = F.sum("n_amostras").over(Window.partitionBy("segmento"))
    return stats.select(
        "segmento",
        cluster,
        "n_amostras",
        F.bround("_rate", 4).alias("churn_rate"),
        risk_label(F.col("_rate")).alias("risk_level"),
        F.bround(F.col("n_amostras") / of_segment * 100, 1).alias("cobertura_pct"),
        *[f"mean_{f}" for f in features],
    )


# Wording of the cards; %s slots are filled in the order given beside each text.
CARD_TEXT = {
    RISK_LOW: (
        "Base %s fidelizada: %s meses de casa, nota %s de satisfação, %s contatos de suporte "
        "e %s dias de atraso por fatura.",
        (("tenure_months", 0), ("satisfaction_score", 1), ("support_calls", 1), ("payment_delay_days", 0)),
    ),
    RISK_HIGH: (
        "Base %s vulnerável: %s meses de casa, mensalidade de R$ %s, nota %s de satisfação, "
        "%s contatos de suporte e %s dias de atraso por fatura.",
        (
            ("tenure_months", 0),
            ("monthly_charges", 0),
            ("satisfaction_score", 1),
            ("support_calls", 1),
            ("payment_delay_days", 0),
        ),
    ),
}
CARD_ACTION = {
    RISK_LOW: "Manter o relacionamento, premiar a permanência e sugerir novos produtos.",
    RISK_HIGH: "Contatar o cliente com prioridade, tratar chamados abertos e propor condição especial.",
}
NO_BOTTLENECK = "Nenhum gargalo relevante"

# Label suffixes, bottleneck codes and tags.
LABEL_SUFFIX = {RISK_LOW: "Estável – Baixo Risco", RISK_HIGH: "Em Risco – Alto Risco"}
BOTTLENECK_DELAY, BOTTLENECK_CALLS = "BU_WAIT_DAYS", "ACCESS_SLA_DAYS alto"
TAGS_SATISFACTION = ("alta_satisfacao", "baixa_satisfacao")
TAGS_TENURE = ("longa_permanencia", "cliente_novo")


def _by_risk(low: Column, high: Column) -> Column:
    return F.when(F.col("risk_level") == RISK_LOW, low).otherwise(high)


def _sentence(risk: str) -> Column:
    template, slots = CARD_TEXT[risk]
    return F.format_string(template, F.col("segmento"), *[fixed(F.col(f"mean_{f}"), d) for f, d in slots])


def profile_cards(profiles: DataFrame, features=FEATURES_8, cluster: str = "cluster_id") -> DataFrame:
    """Cards with label, description, action, bottlenecks and tags from the profiles."""
    delay, calls = F.col("mean_payment_delay_days"), F.col("mean_support_calls")
    bottlenecks = F.array_compact(
        F.array(
            F.when(delay > 5, F.concat(F.lit(f"{BOTTLENECK_DELAY} > "), fixed(delay, 0), F.lit("d"))),
            F.when(calls > 5, BOTTLENECK_CALLS),
        )
    )
    cluster_key = F.concat(F.lit("cluster_"), F.col(cluster).cast("string"))
    tags = F.array(
        F.lower("segmento"),
        tag(F.col("risk_level")),
        cluster_key,
        F.when(F.col("mean_satisfaction_score") >= 7, TAGS_SATISFACTION[0]).otherwise(TAGS_SATISFACTION[1]),
        F.when(F.col("mean_tenure_months") >= 24, TAGS_TENURE[0]).otherwise(TAGS_TENURE[1]),
    )
    means = F.map_from_arrays(
        F.array(*[F.lit(f) for f in features]), F.array(*[F.col(f"mean_{f}") for f in features])
    )
    suffix = _by_risk(F.lit(LABEL_SUFFIX[RISK_LOW]), F.lit(LABEL_SUFFIX[RISK_HIGH]))
    return profiles.select(
        F.col(cluster).cast("int").alias("cluster_id"),
        "segmento",
        F.concat_ws(" ", "segmento", suffix).alias("perfil_label"),
        "risk_level",
        "churn_rate",
        "cobertura_pct",
        "n_amostras",
        _by_risk(_sentence(RISK_LOW), _sentence(RISK_HIGH)).alias("description"),
        means.alias("feature_means"),
        _by_risk(F.lit(CARD_ACTION[RISK_LOW]), F.lit(CARD_ACTION[RISK_HIGH])).alias("action_recommendation"),
        _by_risk(F.array(F.lit(NO_BOTTLENECK)), bottlenecks).alias("gargalos"),
        tags.alias("rag_tags"),
    )


# Caption, feature, decimals and unit of the numeric parts of a card text.
TEXT_PARTS = (
    ("tenure", "tenure_months", 0, "meses"),
    ("cobranca mensal", "monthly_charges", 0, ""),
    ("chamados suporte", "support_calls", 0, ""),
    ("atraso pagamento", "payment_delay_days", 0, "dias"),
    ("satisfacao", "satisfaction_score", 1, ""),
)


def feature_text(means: Column) -> list[Column]:
    """Numeric parts of a card text; a missing mean counts as 0."""
    return [
        F.concat_ws(
            " ",
            F.lit(caption),
            fixed(F.coalesce(F.try_element_at(means, F.lit(name)), F.lit(0.0)), decimals),
            F.nullif(F.lit(unit), F.lit("")),
        )
        for caption, name, decimals, unit in TEXT_PARTS
    ]


def card_text(cards: DataFrame) -> DataFrame:
    """Adds `text`, the searchable form of a card."""
    text = join_parts(
        F.col("perfil_label"),
        F.concat(F.lit("segmento "), "segmento"),
        F.concat(F.lit("risco "), "risk_level"),
        F.col("description"),
        F.col("action_recommendation"),
        F.array_join("rag_tags", " "),
        *feature_text(F.col("feature_means")),
        F.concat(F.lit("churn rate "), fixed(F.col("churn_rate"), 2)),
    )
    return cards.withColumn("text", text)


def category_share(df: DataFrame, cluster: str, category: str) -> DataFrame:
    """Frequency % of each category inside its cluster."""
    counts = df.groupBy(cluster, category).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(cluster))
    return counts.withColumn("pct", F.col("n") / total * 100)


def mean_and_std(df: DataFrame, features, cluster: str) -> DataFrame:
    """cluster, feature, mean, std (population) in long form from one aggregate."""
    wide = df.groupBy(cluster).agg(
        *[
            F.struct(_mean(f).alias("mean"), F.stddev_pop(f).alias("std")).alias(f)
            for f in features
        ]
    )
    return wide.unpivot([cluster], list(features), "feature", "s").select(
        cluster, "feature", "s.mean", "s.std"
    )
