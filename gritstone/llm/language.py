"""Language identification by Bayesian fusion of four kinds of evidence.

text      letter trigrams under a multinomial model of each language, and under a background model in which
          all trigrams of the Latin alphabet are equally likely (the class REJECTED)
declared  the language that the markup or the record declares, given the language (confusion table)
suffix    the language of the address's country suffix, given the language (confusion table)
host      the host's own mix of languages, smoothed towards its domain's, and that towards that of all rows

The trigram model is fitted on a bounded sample, SAMPLE labelled rows of each language (different texts, smallest hashes);
all counts behind the other three cover all rows, as grouped aggregates of the languages that the text alone
suggests. Host counts are joined back by host, never collected: hosts grow with the data, and a host with a
third of the rows is one row of counts. Every language with LEAST_LABELLED different texts is learned, however many there
are: the model has CELLS x languages numbers of four bytes, the confusion tables languages x languages.

Overlapping trigrams repeat each other, so text evidence counts by a third. A row is accepted if its best class is a
language. Rows without any letter are rejected whatever they declare; null and empty texts are such rows. A null
or unknown declaration, a missing address and a null host say nothing. Repeated rows are kept and each is judged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gritstone.llm import htmltext
from gritstone.llm.store import map_text, stored

SAMPLE = 1000
MARGIN = 4
LEAST_LABELLED = 3
REJECTED = "und"
CELLS = 1 << 16
BACKGROUND = -np.log(27.0**3)
ADDED = 0.5
EVERY = 3.0
#: Trigrams looked up at once.
STEP = 1 << 14
REJECT_PRIOR = 0.01
#: Rows of the level above that a host's or a domain's own rows are mixed with.
HOST_WEIGHT, DOMAIN_WEIGHT, GLOBAL_WEIGHT = 20.0, 50.0, 1.0
#: Assumed share of declarations that are right, worth this many rows, before any are counted.
TRUSTED, TRUST_WEIGHT = 0.8, 20.0

# Country suffixes of addresses and the main language of the country.
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en",
                   "ie": "en", "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl", "se": "sv", "ru": "ru", "jp": "ja"}

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:128] = 32
_PLAIN[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)


def trigrams(text: str | None) -> np.ndarray:
    """Cells of the letter trigrams (of UTF-8 bytes, lower case, other characters as one space)."""
    letters = _PLAIN[np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    blank = letters == 32
    letters = letters[~(blank & np.concatenate([[True], blank[:-1]]))] if len(letters) else letters
    if not len(letters):
        return np.zeros(0, dtype=np.int64)
    codes = np.concatenate([[32], letters, [32]]).astype(np.uint32)
    mixed = (codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D))
    return ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(16)).astype(np.int64)


def plain_language(declared: Column) -> Column:
    """The primary subtag in lower case: ``en`` for ``en-GB``."""
    return F.lower(F.regexp_extract(F.coalesce(declared, F.lit("")), r"^\s*([A-Za-z]{2,3})\b", 1))


def fit(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log likelihood by cell and language) of at most SAMPLE different texts of each ``declared`` language."""
    told = labelled.where("declared <> '' and text is not null and text <> ''").select("declared", F.xxhash64("text").alias("hash"), "text")
    different = stored(told.select("declared", "hash").distinct(), "different-texts")
    sizes = stored(different.groupBy("declared").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_LABELLED), "sizes")
    # Hashes so low that a few times SAMPLE different texts of the language have them: n counts no copies.
    share = F.least(F.lit(1.0), F.lit(float(MARGIN * SAMPLE)) / F.col("n"))
    low = different.join(sizes, "declared").where(F.col("hash").cast("double") <= share * float(1 << 64) - float(1 << 63))
    order = Window.partitionBy("declared").orderBy("hash")
    drawn = stored(low.select("declared", "hash").withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE).drop("n"), "drawn")
    languages = sorted(row["declared"] for row in sizes.collect())
    if not languages:
        return [], np.zeros((CELLS, 0), dtype=np.float32)
    sample = told.join(drawn, ["declared", "hash"]).groupBy("declared", "hash").agg(F.min("text").alias("text"))

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, text in zip(batch.column("declared").to_pylist(), batch.column("text")):
                totals.setdefault(language, np.zeros(CELLS, dtype=np.int64))
                totals[language] += np.bincount(trigrams(text.as_py()), minlength=CELLS)
        for language, cells in totals.items():
            at = np.flatnonzero(cells)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(at)), pa.array(at), pa.array(cells[at])], ["language", "cell", "n"])

    counts = sample.mapInArrow(count, "language string, cell bigint, n bigint").groupBy("language", "cell").agg(F.sum("n").alias("n"))
    found = counts.toPandas()  # at most CELLS rows for each language
    table = np.full((CELLS, len(languages)), ADDED)
    for k, language in enumerate(languages):
        own = found[found["language"] == language]
        table[own["cell"].to_numpy(dtype=np.int64), k] += own["n"].to_numpy(dtype=float)
    return languages, np.log(table / table.sum(axis=0)).astype(np.float32)


def text_evidence(rows: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """Replace ``text`` by ``evidence`` (log likelihood of each language over the background), ``letters`` and ``by_text``."""
    names = [c for c in rows.columns if c != "text"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        evidence, sizes, best = [], [], []
        for text in batch.column("text"):
            cells = trigrams(text.as_py())
            over = np.full(len(languages), -BACKGROUND * len(cells))
            for at in range(0, len(cells), STEP):
                over += table[cells[at : at + STEP]].sum(axis=0, dtype=np.float64)
            over /= EVERY
            evidence.append(over)
            sizes.append(len(cells))
            best.append(languages[int(over.argmax())] if len(cells) and len(languages) and over.max() > 0 else None)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array([x.tolist() for x in evidence], pa.list_(pa.float64())),
             pa.array(sizes, pa.int64()), pa.array(best, pa.string())], [*names, "evidence", "letters", "by_text"])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return map_text(rows, run, f"{fields}, evidence array<double>, letters bigint, by_text string")


def _confusion(scored: DataFrame, column: str, languages: list[str]) -> np.ndarray:
    """Log P(value | language), a row for each value and one of zeros for values that are no known language."""
    at = {language: k for k, language in enumerate(languages)}
    counts = np.zeros((len(languages), len(languages)))
    for value, language, n in scored.where(F.col(column).isin(languages) & F.col("by_text").isNotNull()) \
            .groupBy(column, "by_text").count().collect():  # a square of the languages
        counts[at[value], at[language]] = n
    before = np.full(counts.shape, (1 - TRUSTED) / max(1, len(languages) - 1))
    np.fill_diagonal(before, TRUSTED)
    rates = np.log((counts + TRUST_WEIGHT * before) / (counts.sum(axis=0) + TRUST_WEIGHT))
    return np.vstack([rates, np.zeros(len(languages))])


def host_priors(scored: DataFrame, languages: list[str]) -> DataFrame:
    """(host, prior): the smoothed mix of languages of every host, as an array over ``languages``."""
    each = stored(scored.groupBy("host", "domain", "by_text").agg(F.count("*").alias("n")), "hosts")
    told = F.collect_list(F.when(F.col("by_text").isNotNull(), F.struct("by_text", "n")))
    named = each.where(F.col("by_text").isNotNull())
    domains = named.groupBy("domain", "by_text").agg(F.sum("n").alias("n")).groupBy("domain").agg(told.alias("around"))
    joined = each.groupBy("host", "domain").agg(told.alias("own")).join(domains, "domain", "left").select("host", "own", "around")
    at = {language: k for k, language in enumerate(languages)}
    overall = np.zeros(len(languages))
    for language, n in named.groupBy("by_text").agg(F.sum("n")).collect():
        overall[at[language]] = n
    base = (overall + GLOBAL_WEIGHT / len(languages)) / (overall.sum() + GLOBAL_WEIGHT)

    def dense(found: list[dict] | None) -> np.ndarray:
        out = np.zeros(len(at))
        for pair in found or ():
            out[at[pair["by_text"]]] = pair["n"]
        return out

    def run(rows: pa.RecordBatch) -> pa.RecordBatch:
        priors = []
        for own, around in zip(rows.column("own").to_pylist(), rows.column("around").to_pylist()):
            own, around = dense(own), dense(around)
            by_domain = (around + DOMAIN_WEIGHT * base) / (around.sum() + DOMAIN_WEIGHT)
            priors.append((own + HOST_WEIGHT * by_domain) / (own.sum() + HOST_WEIGHT))
        return pa.RecordBatch.from_arrays([rows.column("host"), pa.array(priors, pa.list_(pa.float64()))], ["host", "prior"])

    return map_text(joined, run, "host string, prior array<double>", "own")


def fused(rows: DataFrame, extra: list[str], languages: list[str], declared: np.ndarray, address: np.ndarray) -> DataFrame:
    """(*extra, declared, language, probability) from evidence, prior and the two confusion tables; the best class counts."""
    at = {language: k for k, language in enumerate(languages)}
    names = np.array([*languages, REJECTED])
    order = np.argsort(names, kind="stable")[::-1]  # of equal weights the last name
    of_chance = np.log(len(languages))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        said, suffix = (np.array([at.get(x, len(at)) for x in batch.column(c).to_pylist()], dtype=np.int64) for c in ("declared", "suffix"))
        evidence, prior = (batch.column(c).flatten().to_numpy().reshape(batch.num_rows, len(at)) for c in ("evidence", "prior"))
        joint = evidence + np.log(prior) + declared[said] + address[suffix] + np.log(1 - REJECT_PRIOR)
        blind = np.log(REJECT_PRIOR) - of_chance * ((said < len(at)).astype(float) + (suffix < len(at)))
        weights = np.column_stack([joint, blind])[:, order]
        best = weights.argmax(axis=1)
        shares = np.exp(weights - weights.max(axis=1, keepdims=True)).sum(axis=1)
        blank = batch.column("letters").to_numpy() == 0
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in (*extra, "declared")), pa.array(np.where(blank, REJECTED, names[order][best]).tolist(), pa.string()),
             pa.array(np.where(blank, 1.0, 1.0 / shares), pa.float64())], [*extra, "declared", "language", "probability"])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (*extra, "declared"))
    return map_text(rows.select(*extra, "declared", "suffix", "letters", "evidence", "prior"), run,
                    f"{fields}, language string, probability double", "evidence")


def identify(rows: DataFrame) -> DataFrame:
    """Add ``language``, ``probability`` and ``accepted`` to rows of (text, declared, host, ...) and drop text and host.

    ``declared`` is a language tag or null, ``host`` a host name or another name of the origin, or null.
    """
    host = F.lower(F.coalesce("host", F.lit("")))
    labels = F.split(host, r"\.")
    told = rows.withColumns({
        "declared": plain_language(F.col("declared")), "host": host,
        "domain": F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(""),
        "suffix": F.when(F.size(labels) > 1, F.element_at(labels, -1)).otherwise(""),
    })
    suffix = F.lit("")
    for code, language in SUFFIX_LANGUAGE.items():
        suffix = F.when(F.col("suffix") == code, language).otherwise(suffix)
    told = told.withColumn("suffix", suffix)
    languages, table = fit(told)
    extra = [c for c in rows.columns if c not in ("text", "declared", "host", "language", "probability", "accepted")]
    if not languages:
        return told.select(*extra, "declared", F.lit(REJECTED).alias("language"), F.lit(1.0).alias("probability"), F.lit(False).alias("accepted"))
    scored = stored(text_evidence(told.select(*extra, "declared", "host", "domain", "suffix", "text"), languages, table), "scored")
    priors = stored(host_priors(scored, languages), "priors")
    declared, address = _confusion(scored, "declared", languages), _confusion(scored, "suffix", languages)
    named = fused(scored.join(priors, "host"), extra, languages, declared, address)
    return named.withColumn("accepted", F.col("language") != REJECTED)


def of_documents(docs: DataFrame, keep_tag: bool = False) -> DataFrame:
    """doc_id, key (of the row), declared, language, probability, accepted: ``lang`` declares, ``source`` is the host.

    ``keep_tag`` adds ``tag``, the declaration as it stands.
    """
    tag = [F.col("lang").alias("tag")] if keep_tag else []
    return identify(docs.select("doc_id", F.xxhash64("doc_id", "text", "lang", "source").alias("key"), "text", *tag,
                                F.col("lang").alias("declared"), F.col("source").alias("host")))


def of_pages(pages: DataFrame) -> DataFrame:
    """page_id, declared, language, probability, accepted: the markup declares, the address names the host."""
    def run(rows: pa.RecordBatch) -> pa.RecordBatch:
        texts = ["\n".join(htmltext.blocks(x.as_py() or "")[0]) for x in rows.column("html")]
        return pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("page_id", "declared", "host")), pa.array(texts, pa.string())],
                                          ["page_id", "declared", "host", "text"])

    declared = F.regexp_extract("html", r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", 1)
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    told = pages.select("page_id", declared.alias("declared"), host.alias("host"), "html")
    kind = pages.schema["page_id"].dataType.simpleString()
    return identify(map_text(told, run, f"page_id {kind}, declared string, host string, text string", "html"))


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The accepted documents with all their columns; ``lang`` becomes the identified language."""
    key = F.xxhash64("doc_id", "text", "lang", "source")
    told = of_documents(docs.select("doc_id", "text", "lang", "source"), keep_tag=True)
    other = ~F.col("accepted") | ~F.col("language").eqNullSafe(F.col("tag"))
    changes = stored(told.where(other).groupBy("key").agg(F.min(F.when(F.col("accepted"), F.col("language"))).alias("language")), "changes")
    joined = docs.join(changes, key == changes["key"], "left").where(changes["key"].isNull() | changes["language"].isNotNull())
    return joined.select(*[F.coalesce(changes["language"], docs[c]).alias(c) if c == "lang" else docs[c] for c in docs.columns])
