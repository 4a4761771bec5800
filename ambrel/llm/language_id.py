"""Language identification of web pages by Bayesian evidence fusion.

posterior(lang | page) ~ prior(lang | host) * P(text | lang) ** TEMPER
                         * P(declared | lang) * P(suffix | lang)

* Text: naive Bayes over hashed byte trigrams of the page without markup, trained
  on labelled documents: of each language the TRAIN_DOCS with the smallest id
  hash, a stated bound. The log likelihood is tempered (neighbouring trigrams are
  not independent).
* Declared: the html element's lang attribute, wherever in the page the tag stands
  outside comments, scripts, styles and titles, as one of the known languages,
  other, or none. Suffix: what the address's last label says of a language, or
  nothing. Both tables P(evidence | lang) are estimated from all pages by grouped
  sums of text posteriors, smoothed with PSEUDO.
* Host prior: grouped sums of text posteriors by host, shrunk to those of the
  registered domain (the label before the public suffix, which under a country may
  have two labels, as co.uk), shrunk to those of all pages (KAPPA pseudo-pages
  each); a page's own posterior is left out of its host's and domain's sums.

All sums are partial before they are shuffled; a page's row carries a few numbers.
A host with more than a thousandth of all pages is joined by broadcast (there are
fewer than a thousand such), the others by shuffle.

Pages with null or empty html, url or either get the remaining evidence alone;
html of any length is read whole, in time and memory in proportion. Of languages
with equal posteriors the first by name is given. Rows may repeat; a null page_id
is kept; an empty table gives no rows, and without labelled documents the language
is null. Only page_id, url and html are read, whatever other columns are called.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import as_table, join_skewed

BUCKETS, TRAIN_DOCS, SLICE = 1 << 15, 400, 1 << 16
TEMPER, KAPPA, PSEUDO = 0.3, 8.0, 1.0
OVERSAMPLE, BROADCAST_ROWS = 5, 1_000_000
#: Top-level labels that speak for a language.
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "ie": "en", "nz": "en", "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl", "ru": "ru", "jp": "ja", "cn": "zh"}
#: Second labels that are public under a country's label.
SECOND = {"ac", "co", "com", "edu", "gob", "gov", "gouv", "ltd", "me", "mil", "ne", "net", "nom", "or", "org", "plc", "sch"}
#: Markup, each piece to its end or the page's if it has none, so every character is read once.
_TAGS = re.compile(r"(?is)<(script|style|title)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*(?:>|\Z)")
#: What an html tag does not count in (to its end, or the page's if it has none), or the tag up to its end.
_HTML = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|title)\b.*?(?:</\1\s*>|\Z)|(<html\b[^>]*)")
_LANG = re.compile(r"""(?is)\blang\s*=\s*["']?([a-z]{2,3})\b""")
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)(?=[/?#:]|$)", re.I)


def declared_language(html: str) -> str | None:
    """The lang attribute of the first html tag that has one, in lower case; the whole page is searched."""
    for m in _HTML.finditer(html):
        if m[2] and (said := _LANG.search(m[2])):
            return said[1].lower()
    return None


def registered_domain(host: str) -> str:
    labels = host.split(".")
    public = 2 if len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in SECOND else 1
    return ".".join(labels[-1 - public :])


def trigram_codes(text: str) -> np.ndarray:
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass"), "u1").astype("u4")
    return ((raw[:-2] * np.uint32(2654435761) + raw[1:-1] * np.uint32(40503) + raw[2:] * np.uint32(97)) >> np.uint32(7)) & np.uint32(BUCKETS - 1)


def train(docs: DataFrame, per_language: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages and log P(trigram bucket | language), from doc_id, text and lang of ``docs``.

    Documents are chosen by id hash without their texts: of a language with n those below OVERSAMPLE * per_language / n are
    ranked, a number that does not grow with the input. They are then counted in parallel, a table of BUCKETS counts for
    each language and batch that has any.
    """
    named = docs.where("lang is not null and doc_id is not null and text is not null")
    sizes = as_table(named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    few = sizes.count() * per_language * OVERSAMPLE <= BROADCAST_ROWS
    small = F.broadcast if few else lambda df: df
    u = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(2**53))
    near = named.select("doc_id", "lang", u.alias("u")).join(small(sizes), "lang").where(F.col("u") * F.col("n") <= OVERSAMPLE * per_language)
    order = W.partitionBy("lang").orderBy("u", "doc_id")
    chosen = near.select("doc_id", "lang", F.row_number().over(order).alias("r")).where(F.col("r") <= per_language).select("doc_id", "lang").distinct()
    chosen = as_table(chosen, "chosen")

    def count(batches):
        for batch in batches:
            sums = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                sums.setdefault(lang, np.zeros(BUCKETS, "i8"))
                for codes in _slices(text):
                    sums[lang] += np.bincount(codes, minlength=BUCKETS)
            yield pa.RecordBatch.from_arrays([pa.array([*sums], pa.string()), pa.array([n.astype("<i8").tobytes() for n in sums.values()], pa.binary())], ["lang", "counts"])

    def total(table: pa.Table) -> pa.Table:
        n = sum(np.frombuffer(c, "<i8") for c in table["counts"].to_pylist())
        return pa.table({"lang": table["lang"][:1], "counts": pa.array([n.tobytes()], pa.binary())})

    kind = "lang string, counts binary"
    texts = named.select("doc_id", "lang", "text").join(small(chosen), ["doc_id", "lang"], "left_semi")
    rows = texts.mapInArrow(count, kind).groupBy("lang").applyInArrow(total, kind).collect()  # a row for each language
    found = {r["lang"]: np.frombuffer(r["counts"], "<i8") for r in rows}
    langs = sorted(found)
    tables = np.array([found[x] for x in langs], "f8").reshape(len(langs), BUCKETS) + 0.05
    return langs, np.log(tables / tables.sum(1, keepdims=True))


def _slices(text: str):
    """trigram_codes() of a text of any length, SLICE characters at a time."""
    for at in range(0, max(1, len(text)), SLICE):
        yield trigram_codes(text[at : at + SLICE])


#: The bibliographic codes of ISO 639-2 that differ from the terminological ones.
BIBLIOGRAPHIC = {
    "alb": "sqi", "arm": "hye", "baq": "eus", "bur": "mya", "chi": "zho", "cze": "ces", "dut": "nld", "fre": "fra", "geo": "kat", "ger": "deu",
    "gre": "ell", "ice": "isl", "mac": "mkd", "mao": "mri", "may": "msa", "per": "fas", "rum": "ron", "slo": "slk", "tib": "bod", "wel": "cym",
}


def language_codes(spark, langs: list[str]) -> dict[str, str]:
    """All whole codes of the languages: two letters, three letters (from the JVM's table), bibliographic ones."""
    out = {x: x for x in langs}
    for x in langs:
        try:
            out.setdefault(spark._jvm.java.util.Locale(x).getISO3Language(), x)
        except Py4JJavaError:  # no language of that table
            continue
    return out | {b: out[t] for b, t in BIBLIOGRAPHIC.items() if t in out}


def evidence(pages: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """page_id, host, domain, declared, suffix (numbers: language, L other, L + 1 none) and text (array: tempered log likelihoods, greatest 0)."""
    table, many = np.ascontiguousarray(model.T), len(langs)
    number = {x: i for i, x in enumerate(langs)}
    codes_of = {code: number[x] for code, x in language_codes(pages.sparkSession, langs).items()}

    def run(batches):
        for batch in batches:
            out = []
            for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                found = _HOST.match(url or "")
                host = found[1].lower().rstrip(".") if found else ""
                said = declared_language(html or "")
                declared = codes_of.get(said, many) if said else many + 1
                suffix = number.get(SUFFIXES.get(host.rpartition(".")[2], ""), many + 1)
                text = _TAGS.sub(" ", html or "")
                score = sum(table[codes].sum(0) for codes in _slices(text)) * TEMPER if text.strip() else np.zeros(many)
                out.append((host, registered_domain(host), declared, suffix, (score - score.max(initial=-1e300)).tolist() if many else []))
            cols = [*zip(*out)] or [()] * 5
            types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *[pa.array(list(c), t) for c, t in zip(cols, types)]], ["page_id", "host", "domain", "declared", "suffix", "text"])

    kind = dict(pages.dtypes)["page_id"]
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, host string, domain string, declared int, suffix int, text array<double>")


def _sums(df: DataFrame, *by: str, many: int) -> DataFrame:
    return df.groupBy(*by).agg(F.array(*[F.round(F.sum(F.col("post")[i]), 6) for i in range(many)]).alias("sums"), F.count(F.lit(1)).alias("n"))


def identify(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """page_id, lang, probability, text_lang, declared, host; ``labelled``: doc_id, text and lang to train on."""
    langs, model = train(labelled)
    many = len(langs)
    if not many:
        return pages.select("page_id").withColumns({"lang": F.lit(None).cast("string"), "probability": F.lit(0.0), "text_lang": F.lit(None).cast("string"), "declared": F.lit(None).cast("string"), "host": F.lit("")})
    found = as_table(evidence(pages, langs, model), "evidence")
    power = F.transform("text", lambda x: F.exp(x))
    post = F.transform(power, lambda x: F.round(x / F.aggregate(power, F.lit(0.0), lambda a, y: a + y), 9))
    found = found.withColumn("post", post)
    likelihood = {}
    for name in ("declared", "suffix"):  # (L + 2) rows
        table = np.full((many + 2, many), PSEUDO)
        for r in _sums(found, name, many=many).collect():
            table[r[name]] += r["sums"]
        likelihood[name] = np.log(table / table.sum(0))
    whole = found.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("post")[i]).alias(f"s{i}") for i in range(many)]).first()
    overall = np.array([whole[f"s{i}"] or 0.0 for i in range(many)]) + 1.0
    overall = np.round(overall / overall.sum(), 9)
    by_host = as_table(_sums(found, "host", "domain", many=many).withColumnRenamed("sums", "h"), "hosts")
    sites = by_host.groupBy("domain").agg(F.count(F.lit(1)).alias("sites"), F.array(*[F.round(F.sum(F.col("h")[i]), 6) for i in range(many)]).alias("d"))
    hosts = join_skewed(by_host, as_table(sites, "domains"), "domain", "sites", by_host.count())
    joined = join_skewed(found.drop("domain"), as_table(hosts.select("host", "h", "d", "n"), "priors"), "host", "n", whole["n"])
    base = F.array(*[F.lit(float(x)) for x in overall])
    own = lambda name: F.zip_with(name, "post", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    domain = F.zip_with(own("d"), base, lambda a, b: (a + KAPPA * b) / (total(own("d")) + KAPPA))
    joined = joined.withColumn("domain_prior", domain)
    host = F.zip_with(own("h"), "domain_prior", lambda a, b: (a + KAPPA * b) / (total(own("h")) + KAPPA))
    joined = joined.withColumn("prior", host)
    row = lambda t: F.array(*[F.array(*[F.lit(float(np.round(v, 9))) for v in r]) for r in t])
    logs = F.array(*[F.log(F.col("prior")[i]) + F.col("text")[i] + row(likelihood["declared"])[F.col("declared")][i] + row(likelihood["suffix"])[F.col("suffix")][i] for i in range(many)])
    joined = joined.withColumn("logs", logs)
    top = F.array_max("logs")
    names = F.array(*map(F.lit, langs))
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    probability = 1 / F.aggregate(F.transform("logs", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)
    return joined.select("page_id", best(F.col("logs")).alias("lang"), F.round(probability, 4).alias("probability"), best(F.col("text")).alias("text_lang"), F.get(names, F.col("declared")).alias("declared"), "host")


def query(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))
