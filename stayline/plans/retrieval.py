"""Retrieval over documents, embeddings and profile cards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.numeric import exact_sum
from stayline.functions.text import join_parts, tokens, uni_bigrams
from stayline.operators import dense, lsh, retrieval, segment
from stayline.plans.base import FEATURES_8, clean_customers, query, table
from stayline.plans.evaluation import _rounded
from stayline.plans.segmentation import CARDS, cards
from stayline.session import kept_scratch, materialize, new_path

DIMS = 64

_GRAMS = """list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))"""


def grams_sql(name: str, source: str, key: str, text: str, extra: str = "") -> str:
    return f"""
{name}_t AS (SELECT {key}{extra}, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM {source}),
{name}_c AS (SELECT {key}{extra}, term, count(*) AS c FROM (SELECT {key}{extra}, unnest({_GRAMS}) AS term FROM {name}_t) GROUP BY ALL)"""


def index_sql(source: str, key: str, text: str, extra: str = "") -> str:
    return (
        grams_sql("d", source, key, text, extra)
        + f""",
idf AS (SELECT term, count(*) AS df, ln((1e0 + (SELECT count(*) FROM {source})) / (1 + count(*))) + 1 AS idf FROM d_c GROUP BY term),
dw AS (SELECT d_c.{key}, d_c.term, (1 + ln(c)) * idf AS w FROM d_c JOIN idf ON d_c.term = idf.term),
dn AS (SELECT {key}, sqrt(sum(w * w)) AS norm, count(*) AS n_terms FROM dw GROUP BY {key})"""
    )


def search_sql(source: str, key: str, text: str, queries: str, qkey: str, qtext: str, k: int, extra: str = "", seg: str | None = None) -> str:
    """Full scan of query x document scores, zero scores included."""
    cond = f"WHERE q.seg IS NULL OR q.seg = d.{seg}" if seg else ""
    return (
        index_sql(source, key, text, extra)
        + ","
        + grams_sql("q", queries, qkey, qtext)
        + f""",
qw AS (SELECT {qkey}, q_c.term, (1 + ln(c)) * idf AS w FROM q_c JOIN idf ON q_c.term = idf.term),
qn AS (SELECT {qkey}, sqrt(sum(w * w)) AS norm FROM qw GROUP BY {qkey}),
dots AS (SELECT qw.{qkey}, dw.{key}, sum(qw.w * dw.w) AS dot FROM qw JOIN dw ON qw.term = dw.term GROUP BY ALL),
sims AS (SELECT dots.{qkey}, dots.{key}, round(dot / qn.norm / dn.norm, 6) AS score FROM dots
         JOIN qn ON qn.{qkey} = dots.{qkey} JOIN dn ON dn.{key} = dots.{key}),
every AS (SELECT q.{qkey}, d.{key}, coalesce(s.score, 0e0) AS score FROM {queries} q CROSS JOIN {source} d
          LEFT JOIN sims s ON s.{qkey} = q.{qkey} AND s.{key} = d.{key} {cond}),
hits AS (SELECT *, CAST(row_number() OVER (PARTITION BY {qkey} ORDER BY score DESC, {key} DESC) AS INTEGER) AS rank FROM every
         QUALIFY rank <= {k})"""
    )


def documents(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "lang", "text")


_INDEXES: dict = {}


def doc_index(spark, sf) -> retrieval.TfidfIndex:
    """The index of a corpus, built once per application and shared by all queries on it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _INDEXES:
        with kept_scratch():
            _INDEXES[key] = retrieval.build_index(documents(spark, sf), "doc_id", "text", segment="lang")
    return _INDEXES[key]


def text_queries(spark, sf) -> DataFrame:
    """Benchmark texts as requests; short ones ask for English, long ones for French."""
    n = F.length("text")
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"),
        F.col("text").alias("query"),
        F.when(n < 200, "en").when(n >= 300, "fr").alias("seg"),
    )


_QUERIES = "qs AS (SELECT item_id AS query_id, text AS query, CASE WHEN length(text) < 200 THEN 'en' WHEN length(text) >= 300 THEN 'fr' END AS seg FROM benchmark),"


@query(
    f"""WITH {grams_sql('d', 'documents', 'doc_id', 'text')}
    SELECT t.doc_id, len(t) AS n_tokens, coalesce(g.n, 0)::BIGINT AS n_grams, coalesce(g.k, 0) AS n_terms FROM d_t t
    LEFT JOIN (SELECT doc_id, sum(c) AS n, count(*) AS k FROM d_c GROUP BY doc_id) g ON g.doc_id = t.doc_id"""
)
def ngram_counts(spark, sf) -> DataFrame:
    """Tokens, 1-2-grams and distinct ones per document, without leaving the row."""
    toks = documents(spark, sf).select("doc_id", tokens(F.col("text")).alias("t"))
    grams = toks.withColumn("g", uni_bigrams(F.col("t")))
    return grams.select(
        "doc_id",
        F.size("t").cast("bigint").alias("n_tokens"),
        F.size("g").cast("bigint").alias("n_grams"),
        F.size(F.array_distinct("g")).cast("bigint").alias("n_terms"),
    )


@query(
    f"""WITH {index_sql('documents', 'doc_id', 'text')} SELECT d.doc_id, round(coalesce(norm, 0), 6) AS norm,
    coalesce(n_terms, 0) AS n_terms FROM documents d LEFT JOIN dn ON dn.doc_id = d.doc_id"""
)
def tfidf_document_norms(spark, sf) -> DataFrame:
    return _rounded(doc_index(spark, sf).norms.select("doc_id", "norm", "n_terms"), "norm")


@query(f"WITH {index_sql('documents', 'doc_id', 'text')} SELECT term, df, round(idf, 6) AS idf FROM idf")
def tfidf_vocabulary(spark, sf) -> DataFrame:
    return _rounded(doc_index(spark, sf).terms.select("term", "df", "idf"), "idf")


@query(
    f"""WITH {index_sql('documents', 'doc_id', 'text')} SELECT dw.doc_id, count(*) AS n_terms, round(max(w / norm), 6) AS top_weight,
    round(sum(w / norm), 4) AS weight_sum FROM dw JOIN dn ON dn.doc_id = dw.doc_id GROUP BY dw.doc_id"""
)
def tfidf_weights(spark, sf) -> DataFrame:
    """Summary per document of the unit-length weights."""
    w = doc_index(spark, sf).weights()
    return _rounded(_rounded(w, "top_weight"), "weight_sum", digits=4)


_HITS = _QUERIES + search_sql("documents", "doc_id", "text", "qs", "query_id", "query", 3, seg="lang")


@query(f"WITH {_HITS} SELECT query_id, doc_id, score, rank FROM hits")
def tfidf_search(spark, sf) -> DataFrame:
    """Top 3 documents per benchmark text inside the requested language."""
    queries = text_queries(spark, sf)
    return retrieval.search(queries, doc_index(spark, sf), segment="seg", k=3, decimals=6)


@query(f"WITH {_HITS} SELECT query_id, doc_id, score, rank FROM hits")
def tfidf_search_pruned(spark, sf) -> DataFrame:
    """The same search by the way that large query batches take."""
    queries = text_queries(spark, sf)
    return retrieval.search(queries, doc_index(spark, sf), segment="seg", k=3, decimals=6, direct_pairs=0)


@query(
    f"""WITH {_QUERIES}{search_sql('documents', 'doc_id', 'text', 'qs', 'query_id', 'query', 12)},
    kept AS (SELECT h.query_id, h.doc_id, h.score FROM hits h JOIN documents d ON d.doc_id = h.doc_id
             JOIN qs ON qs.query_id = h.query_id WHERE seg IS NULL OR seg = lang)
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id DESC) AS INTEGER) AS rank
    FROM kept QUALIFY rank <= 3"""
)
def tfidf_overfetch(spark, sf) -> DataFrame:
    """The variant that ranks 4k documents first and filters after."""
    queries = text_queries(spark, sf)
    return retrieval.search_overfetch(queries, doc_index(spark, sf), segment="seg", k=3, decimals=6)


@query(
    f"""WITH {_HITS} SELECT h.query_id, h.doc_id, rank, round_even(score::DECIMAL(12,6), 4)::DOUBLE AS relevance_score,
    d.lang, d.source FROM hits h JOIN documents d ON d.doc_id = h.doc_id"""
)
def search_results(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    hits = retrieval.attach(tfidf_search(spark, sf), docs, "doc_id")
    return hits.select("query_id", "doc_id", "rank", "relevance_score", "lang", "source")


@query(
    f"""WITH {_HITS} SELECT query_id, string_agg(text, chr(10) ORDER BY rank) AS context
    FROM hits h JOIN documents d ON d.doc_id = h.doc_id GROUP BY query_id"""
)
def prompt_contexts(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return retrieval.prompt_context(retrieval.attach(tfidf_search(spark, sf), docs, "doc_id"), "query_id", "text")


@query(
    """WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+'), lambda x: x <> '') AS t FROM documents),
    s AS (SELECT doc_id, t, unnest(range(0, greatest(len(t) - 51, 0) + 1, 462)) AS start FROM t WHERE len(t) > 0)
    SELECT doc_id, CAST(start // 462 AS INTEGER) AS chunk, CAST(len(t[start + 1:start + 512]) AS INTEGER) AS n_tokens,
           array_to_string(t[start + 1:start + 512], ' ') AS chunk_text FROM s"""
)
def document_chunks(spark, sf) -> DataFrame:
    return retrieval.chunk_documents(table(spark, sf, "documents"))


@query("SELECT lang, source, count(*) AS n, CASE WHEN count(*) >= 5 THEN 1 ELSE 0 END AS pass FROM documents GROUP BY ALL")
def documents_per_profile(spark, sf) -> DataFrame:
    counts = table(spark, sf, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pass", (F.col("n") >= 5).cast("int"))


# --- dense vectors -------------------------------------------------------------------

_UNIT = """
u AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
             CASE WHEN list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) = 0 THEN 1
             ELSE sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) END AS norm FROM embeddings),
unit AS (SELECT vec_id, label, norm, list_transform(v, lambda x: x / norm) AS unit FROM u)"""


def unit_embeddings(spark, sf) -> DataFrame:
    return dense.unit_vectors(table(spark, sf, "embeddings"), "embedding").select("vec_id", "label", "norm", "unit")


@query(
    f"""WITH {_UNIT} SELECT vec_id, CAST(i AS INTEGER) AS dim, round(unit[i + 1], 6) AS x FROM
    (SELECT vec_id, unit, unnest(range(len(unit))) AS i FROM unit)"""
)
def unit_vectors(spark, sf) -> DataFrame:
    df = unit_embeddings(spark, sf).select("vec_id", F.posexplode("unit").alias("dim", "x"))
    return _rounded(df, "x")


_CENTROID = f"""{_UNIT},
cent AS (SELECT label AS query_id, list(m ORDER BY i) AS q FROM (
    SELECT label, i, avg(unit[i + 1]) AS m FROM (SELECT label, unit, unnest(range({DIMS})) AS i FROM unit) GROUP BY label, i) GROUP BY label)"""


def label_queries(spark, sf, units: DataFrame) -> DataFrame:
    c = dense.group_centroids(units, "label", "unit", DIMS)
    return c.select(F.col("label").cast("bigint").alias("query_id"), F.col("centroid").alias("unit"))


def dense_hits(spark, sf, k: int) -> DataFrame:
    units = materialize(unit_embeddings(spark, sf), "unit-vectors")
    queries = materialize(label_queries(spark, sf, units), "label-queries")
    return dense.search_dense(units.select("vec_id", "unit"), queries, k=k, key="vec_id")


_DENSE = f"""{_CENTROID},
sims AS (SELECT query_id::BIGINT AS query_id, vec_id, round(list_inner_product(q, unit), 6) AS score FROM cent, unit)"""


@query(
    f"""WITH {_DENSE} SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id DESC) AS INTEGER) AS rank
    FROM sims QUALIFY rank <= 5"""
)
def dense_search(spark, sf) -> DataFrame:
    """Nearest vectors by inner product to the mean vector of every label."""
    return dense_hits(spark, sf, 5)


NEAREST = 5


@query(
    """WITH q AS (SELECT count(DISTINCT label) + count(*) FILTER (vec_id % 50 = 0) AS n FROM embeddings)
    SELECT n AS n_queries, n * least(5, (SELECT count(*) - 1 FROM embeddings)) AS n_hits, 0::BIGINT AS wrong_scores, 1 AS recalled FROM q"""
)
def dense_search_lsh(spark, sf) -> DataFrame:
    """Nearest vectors of each label's mean and of every 50th vector (without itself) from the stored bucket index,
    read back by its path: hits, scores that are not the inner product, and whether 0.9 of the exact hits are there."""
    units = materialize(unit_embeddings(spark, sf), "unit-vectors")
    means = label_queries(spark, sf, units).select((-1 - F.col("query_id")).alias("query_id"), "unit")
    picked = units.filter("vec_id % 50 = 0").select(F.col("vec_id").cast("bigint").alias("query_id"), "unit")
    queries = materialize(means.unionByName(picked), "lsh-batch")
    path = new_path(spark, "lsh-index")
    lsh.build_index(units, path, "vec_id", "unit")
    other = Window.partitionBy("query_id").orderBy("rank")

    def nearest(found: DataFrame) -> DataFrame:
        rest = found.filter("query_id <> vec_id").withColumn("_at", F.row_number().over(other))
        return rest.filter(F.col("_at") <= NEAREST).select("query_id", "vec_id", "score")

    got = nearest(lsh.search_lsh(lsh.open_index(spark, path), queries, k=NEAREST + 1))
    exact = nearest(dense.search_dense(units.select("vec_id", "unit"), queries, k=NEAREST + 1, key="vec_id"))
    both = got.join(exact.withColumnRenamed("score", "true_score"), ["query_id", "vec_id"], "full")
    found, known = F.count("score"), F.count("true_score")
    shared = F.count(F.when(F.col("score").isNotNull() & F.col("true_score").isNotNull(), 1))
    counted = both.agg(
        found.alias("n_hits"),
        F.count_if(F.abs(F.col("score") - F.col("true_score")) > 2e-6).alias("wrong_scores"),
        (shared >= 0.9 * known).cast("int").alias("recalled"),
    )
    return counted.select(F.lit(queries.count()).cast("bigint").alias("n_queries"), "*")


@query(
    f"""WITH {_DENSE}, hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id DESC) AS rank
      FROM sims QUALIFY rank <= 5),
    f AS (SELECT e.label, e.label::BIGINT AS query_id, count(h.vec_id) AS found, count(*) AS relevant FROM embeddings e
          LEFT JOIN hits h ON h.query_id = e.label AND h.vec_id = e.vec_id GROUP BY e.label)
    SELECT f.label, round(found / relevant, 6) AS recall,
      round(found / (SELECT count(*) FROM hits h WHERE h.query_id = f.query_id), 6) AS context_precision FROM f"""
)
def retrieval_quality(spark, sf) -> DataFrame:
    """Recall@5 and context precision per label: vectors of the label are relevant."""
    relevance = table(spark, sf, "embeddings").select(
        "label", F.col("label").cast("bigint").alias("query_id"), "vec_id"
    )
    q = retrieval.retrieval_quality(dense_hits(spark, sf, 5), relevance, "query_id", "vec_id", "label")
    return _rounded(q, "recall", "context_precision")


# --- cards ---------------------------------------------------------------------------


def nation_queries(spark, sf) -> DataFrame:
    """One description per nation from the mean features of its customers."""
    nations = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), "c_nationkey")
    means = (
        clean_customers(spark, sf)
        .join(nations, "customer_id")
        .groupBy("c_nationkey")
        .agg(*[F.bround(exact_sum(f) / F.count(f), 3).alias(f) for f in FEATURES_8])
    )
    as_map = F.create_map(*[x for f in FEATURES_8 for x in (F.lit(f), F.col(f))])
    return means.select(
        F.col("c_nationkey").cast("bigint").alias("query_id"),
        join_parts(F.lit("segmento PJ"), *segment.feature_text(as_map)).alias("query"),
        F.when(F.col("monthly_charges") > 150, "PJ").alias("seg"),
    )


def _fmt(col: str, d: int) -> str:
    return f"printf('%.{d}f', round({col}, {d}))"


_NATION = f""",
nm AS (SELECT c_nationkey::BIGINT AS query_id, {', '.join(f'round_even(CAST(sum(CAST(clean.{f} AS DECIMAL(28,6))) AS DOUBLE) / count(*), 3) AS {f}' for f in FEATURES_8)}
       FROM clean JOIN customer ON c_custkey = customer_id GROUP BY c_nationkey),
qs AS (SELECT query_id, concat_ws(' ', 'segmento PJ', concat('tenure ', {_fmt('tenure_months', 0)}, ' meses'),
    concat('cobranca mensal ', {_fmt('monthly_charges', 0)}), concat('chamados suporte ', {_fmt('support_calls', 0)}),
    concat('atraso pagamento ', {_fmt('payment_delay_days', 0)}, ' dias'), concat('satisfacao ', {_fmt('satisfaction_score', 1)})) AS query,
    CASE WHEN monthly_charges > 150 THEN 'PJ' END AS seg FROM nm),
cdocs AS (SELECT concat(segmento, '/cluster_', cluster_id) AS card_key, segmento, text FROM texts),"""


@query(
    f"""WITH {CARDS}{_NATION}{search_sql('cdocs', 'card_key', 'text', 'qs', 'query_id', 'query', 3, seg='segmento')}
    SELECT query_id, card_key, score, rank FROM hits"""
)
def card_search(spark, sf) -> DataFrame:
    """Best cards for the average customer of every nation."""
    texts = segment.card_text(cards(spark, sf)).select(
        F.concat("segmento", F.lit("/cluster_"), F.col("cluster_id").cast("string")).alias("card_key"),
        "segmento",
        "text",
    )
    index = retrieval.build_index(materialize(texts, "cards"), "card_key", "text", segment="segmento")
    return retrieval.search(materialize(nation_queries(spark, sf), "nation-queries"), index, segment="seg", k=3, decimals=6)


def _card_fields(spark, sf) -> DataFrame:
    """Cards by key, with the fields of a search result."""
    key = F.concat(F.lit("cluster_"), F.col("cluster_id").cast("string"))
    profile = F.struct("n_amostras", "churn_rate", "description", "action_recommendation")
    return cards(spark, sf).select(
        F.concat("segmento", F.lit("/"), key).alias("card_key"),
        "segmento",
        "cluster_id",
        key.alias("cluster_key"),
        "perfil_label",
        "risk_level",
        profile.alias("profile"),
    )


@query(
    f"""WITH {CARDS}{_NATION}{search_sql('cdocs', 'card_key', 'text', 'qs', 'query_id', 'query', 3, seg='segmento')}
    SELECT query_id, rank, c.segmento, c.cluster_id, concat('cluster_', c.cluster_id) AS cluster_key, perfil_label, risk_level,
      score AS relevance_score, n_amostras, churn_rate, description, action_recommendation
    FROM hits JOIN texts c ON card_key = concat(c.segmento, '/cluster_', c.cluster_id)"""
)
def card_search_results(spark, sf) -> DataFrame:
    """The hits of a card search with their seven fields; the profile is spread over columns."""
    found = card_search(spark, sf).join(_card_fields(spark, sf), "card_key")
    fields = ("segmento", "cluster_id", "cluster_key", "perfil_label", "risk_level")
    return found.select("query_id", "rank", *fields, F.col("score").alias("relevance_score"), "profile.*")


@query(
    f"""WITH cdocs AS (SELECT doc_id, text, concat(lang, '/', source) AS kind FROM documents),
    qs AS (SELECT item_id AS query_id, text AS query, CASE WHEN item_id % 2 = 0 THEN concat('en/src', item_id % 20) END AS seg FROM benchmark),
    {search_sql('cdocs', 'doc_id', 'text', 'qs', 'query_id', 'query', 3, extra=', kind', seg='kind')}
    SELECT query_id, doc_id, score, rank FROM hits"""
)
def filtered_search(spark, sf) -> DataFrame:
    """Search with a filter on two properties of a document at once, its language and its source."""
    docs = table(spark, sf, "documents").select("doc_id", "text", F.concat("lang", F.lit("/"), "source").alias("kind"))
    index = retrieval.build_index(docs, "doc_id", "text", segment="kind")
    item = F.col("item_id")
    queries = table(spark, sf, "benchmark").select(
        item.alias("query_id"),
        F.col("text").alias("query"),
        F.when(item % 2 == 0, F.concat(F.lit("en/src"), (item % 20).cast("string"))).alias("seg"),
    )
    return retrieval.search(queries, index, segment="seg", k=3, decimals=6)
