"""Language identification by Bayesian fusion of text, declared language, address and host evidence."""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.wordbytes import mix, raw_bytes, slices
from stayline.session import broadcast_if_small, materialize

BITS = 16  # slots of hashed letter groups
GRAM = 3  # bytes of a group
DENSE_LANGUAGES = 64  # with more of them, a task hands on its counts after each slice
TEMPER, MOST = 0.25, 200  # groups overlap and repeat: each counts a quarter, at most as many as 200
KAPPA = 4.0  # texts that the level above counts for in a host's prior
SMALL_ROWS = 100_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_HIDDEN = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)


def visible_text(source: str | None) -> str:
    """Text of a page without tags, comments, scripts and styles."""
    return html.unescape(_HIDDEN.sub(" ", source or ""))


def grams(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets and slots of all groups of GRAM bytes that lie in one text (A-Z in lower case)."""
    data, offsets = raw_bytes(column)
    data = _LOWER[data].astype(np.uint64)
    n = max(0, len(data) - GRAM + 1)
    code = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        code = code * np.uint64(256) + data[k : k + n]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[:n] == row[GRAM - 1 :] if n else np.zeros(0, bool)
    slots = (mix(code[inside]) >> np.uint64(64 - bits)).astype(np.int64)
    return np.searchsorted(row[:n][inside], np.arange(len(offsets))), slots


def learns(key: str) -> Column:
    """Rows whose language is learned: crc32 of the id as text, mod 5, is not 0; not rows with a NULL id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 != 0, F.lit(False))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", bits: int = BITS):
    """(languages, log likelihoods: slots x languages, log shares) from all texts with a known language.

    The languages are all labels. Counts are made in the tasks and added in a grouped aggregate of at most
    2 ** bits x languages rows, whatever the input.
    """
    known = docs.filter(F.col(label).isNotNull() & learns(key))
    rows = known.groupBy(label).count().collect()
    count = {r[0]: r["count"] for r in rows}
    names = sorted(count)
    if not names:
        return [], np.zeros((1 << bits, 0)), np.zeros(0)
    share = np.array([count[x] for x in names], dtype=np.float64)
    place = {x: k for k, x in enumerate(names)}

    def run(batches):
        dense = len(names) <= DENSE_LANGUAGES
        counts = np.zeros((1 << bits) * len(names) if dense else 0, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, text):
                at, slots = grams(part.column(text), bits)
                lang = np.array([place[x] for x in part.column(label).to_pylist()])
                cells = slots * len(names) + np.repeat(lang, np.diff(at))
                if dense:
                    counts += np.bincount(cells, minlength=len(counts))
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.unique(cells, return_counts=True)], names=["cell", "n"])
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["cell", "n"])

    cells = known.select(F.col(f"`{text}`"), F.col(f"`{label}`")).mapInArrow(run, "cell bigint, n bigint")
    table = cells.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.full((1 << bits) * len(names), 0.5)
    counts[table["cell"].to_numpy()] += table["n"].to_numpy()
    counts = counts.reshape(-1, len(names))
    return names, np.log(counts / counts.sum(0)), np.log(share / share.sum())


def text_evidence(rows: DataFrame, model, text: str, marked_up: bool, keep) -> DataFrame:
    """`keep` columns, n_grams, and evidence array<double>: tempered log likelihoods, the best one 0."""
    names, logp, _ = model
    shared = rows.sparkSession.sparkContext.broadcast(logp)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches):
        table = shared.value
        for batch in batches:
            for part in slices(batch, text):
                column = part.column(text)
                if marked_up:
                    column = pa.array([visible_text(x) for x in column.to_pylist()], pa.large_string())
                at, slots = grams(column)
                n = np.diff(at)
                like = np.zeros((part.num_rows, len(names)))
                for k in range(len(names)):
                    sums = np.concatenate([[0], np.cumsum(table[slots, k])])
                    like[:, k] = (sums[at[1:]] - sums[at[:-1]]) / np.maximum(1, n)
                like *= (TEMPER * np.minimum(n, MOST))[:, None]
                if len(names):
                    like -= like.max(axis=1, keepdims=True)
                cols = [part.column(c) for c in keep]
                cols += [pa.array(n), pa.array(like.tolist(), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, "n_grams", "evidence"])

    ddl = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    return rows.select(*keep, text).mapInArrow(run, ddl + "n_grams bigint, evidence array<double>")


def host_of(url: str) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(host, F.lit(""))


def declared_language(source: str) -> Column:
    """First subtag of the lang attribute of the html element, in lower case; NULL if there is none."""
    tag = F.regexp_extract(source, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", 1)
    return F.nullif(F.lower(tag), F.lit(""))


def _let(value: Column, use) -> Column:
    """`use` of a value that is computed once, also where `use` goes through an array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def _soft(logs: Column) -> Column:
    """Probabilities from an array of logs (its greatest is found first)."""
    raised = lambda x: _let(F.array_max(x), lambda top: F.transform(x, lambda v: F.exp(v - top)))
    return _let(_let(logs, raised), lambda w: _let(_total(w), lambda t: F.transform(w, lambda v: v / t)))


def _literals(values) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def fuse(rows: DataFrame, model, kappa: float = KAPPA) -> DataFrame:
    """Adds lang, probability, text_lang to `rows` (host, declared, n_grams, evidence, other columns).

    The posterior of a language is its text likelihood x P(declared | language) x P(suffix |
    language) x the prior of the host. All tables are grouped sums of the text-only posteriors: of
    (declared), (suffix), and hosts. A host's prior is its own shares, drawn to those of its domain
    by `kappa` texts, the domain's to its suffix's, and that to all rows'; a row's own share is taken out
    of its host first. Rows without a host or a declared language get the level above, or no
    factor. A host with many rows is summed in the tasks first, and its rows are split by Spark's skew join.
    """
    names, _, share = model
    n = len(names)
    if not n:
        return rows.drop("evidence").withColumns(
            {"lang": F.lit(None).cast("string"), "probability": F.lit(None).cast("double"), "text_lang": F.lit(None).cast("string")}
        )
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    parts = F.split("host", r"\.")
    rows = materialize(
        rows.withColumns(
            {
                "_q": _soft(add("evidence", _literals(share))),
                "suffix": F.element_at(parts, -1),
                "domain": F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - 1), F.lit(2)), "."),
            }
        ),
        "language-evidence",
    )

    def summed(df, by, name, values="_q"):
        sums = [F.sum(F.get(values, F.lit(k))) for k in range(n)]
        return df.filter(F.col(by[0]).isNotNull()).groupBy(*by).agg(F.array(*sums).alias(name))

    q = [F.get("_q", F.lit(k)) for k in range(n)]
    tagged = [F.sum(F.when(F.col("declared").isNotNull(), c)) for c in q]
    sums = np.array([x or 0.0 for x in rows.agg(*[F.sum(c) for c in q], *tagged).first()])
    whole, with_tag = sums[:n] + 1e-3, sums[n:]
    hosts = materialize(summed(rows, ["host", "domain", "suffix"], "_h"), "hosts")
    domains = summed(hosts, ["domain", "suffix"], "_d", "_h")
    suffixes = materialize(summed(domains, ["suffix"], "_s", "_d"), "suffixes")
    tags = summed(rows, ["declared"], "_t")

    def level(counts, above):
        """Shares of a level, drawn to those of the level above."""
        return _let(_total(counts), lambda t: F.zip_with(counts, above, lambda c, a: (c + kappa * a) / (t + kappa)))

    all_share, zeros = _literals(whole / whole.sum()), _literals(np.zeros(n))
    # P(suffix | language) goes with the suffix level of the host's prior: its shares are P(language | suffix).
    at_suffix = suffixes.select("suffix", level(F.col("_s"), all_share).alias("_S"))
    at_domain = domains.join(broadcast_if_small(at_suffix, SMALL_ROWS), "suffix")
    at_domain = at_domain.select("domain", level(F.col("_d"), F.col("_S")).alias("_D"))
    at_host = hosts.join(at_domain, "domain").select("host", "_h", "_D")
    given = F.zip_with("_t", _literals(with_tag + 1), lambda t, w: F.log((t + 0.5) / w))
    tags = tags.select("declared", given.alias("_T"))
    joined = rows.join(broadcast_if_small(tags, SMALL_ROWS), "declared", "left").join(at_host, "host", "left")
    others = F.coalesce(F.zip_with("_h", "_q", lambda h, c: F.greatest(h - c, F.lit(0.0))), zeros)
    prior = _let(others, lambda c: level(c, F.coalesce("_D", all_share)))
    logs = add(add("evidence", F.transform(prior, lambda x: F.log(x))), F.coalesce("_T", zeros))
    joined = joined.withColumn("_post", _soft(logs))
    named = F.array(*map(F.lit, names))
    best = lambda x: F.element_at(named, F.array_position(x, F.array_max(x)).cast("int"))
    return joined.withColumns({"lang": best("_post"), "probability": F.array_max("_post"), "text_lang": best("_q")}).select(
        *[c for c in rows.columns if c not in {"evidence", "suffix", "domain", "_q"}], "lang", "probability", "text_lang"
    )


def identify(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """A row per page and per document: page_id, doc_id (one is NULL), host, declared, n_grams, lang,
    probability, text_lang.

    Text likelihoods are learned from the documents' `lang`, except those with crc32(doc_id) mod 5 = 0,
    and from all of each text. Pages bring their visible text, the html element's lang, and their
    host; documents have no markup or address, their `source` is the host. Rows without text are
    decided by the other evidence, at last by the shares of all rows; ties go to the first language in
    order. NULL ids, texts, urls and sources are allowed; repeated rows count and come back as often;
    without any known language lang is NULL. Other columns are not read.
    """
    model = train(docs)
    pages = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.lit(None).cast("bigint").alias("doc_id"),
        host_of("url").alias("host"), declared_language("html").alias("declared"), "html",
    )
    docs = docs.select(
        F.lit(None).cast("bigint").alias("page_id"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.concat(F.col("source"), F.lit(".source")).alias("host"), F.lit(None).cast("string").alias("declared"), "text",
    )
    keep = ["page_id", "doc_id", "host", "declared"]
    both = text_evidence(pages, model, "html", True, keep).unionByName(text_evidence(docs, model, "text", False, keep))
    return fuse(both, model)
