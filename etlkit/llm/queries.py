"""The registered queries of this subpackage; each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etlkit.llm import decontam, html_blocks, licenses, mixing, nbsvm, phrases, secret_scan, simhash, tokens, toxicity, urls, vectors, whitening
from etlkit.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

# Seed words of the weak category labels; every category is also bound to the label ``toxic``.
TOXIC_CATEGORIES = {
    "insult": ("idiot", "moron", "stupid", "clown", "loser"),
    "contempt": ("trash", "scum", "worthless", "pathetic", "disgusting"),
}


@query()
def op1_html_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html_blocks.extracted(pages, html_blocks.fit_pages(pages))


@query()
def op2_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity probabilities of every document, by a chain fitted on labelled rows."""
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), "toxic", TOXIC_CATEGORIES)
    return toxicity.scored(docs.select("doc_id", "text"), chain).drop("text")


@query()
def op3_nb_svm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; rows whose crc32 leaves 1 on division by 3 are held out."""
    docs = table(spark, sf_dir, "documents")
    remainder = lambda c: F.crc32(F.col(c).cast("string")) % 3
    model = nbsvm.fit_quality(docs, table(spark, sf_dir, "labels"), "quality", remainder("__id") != 1)
    found = nbsvm.scored(docs, model)
    return found.select("doc_id", (remainder("doc_id") == 1).alias("held_out"), "score", "predicted")


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document by the public 32k BPE model."""
    return tokens.token_counts(table(spark, sf_dir, "documents"))


@query()
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict; values as digests."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.sha2("value", 256).alias("value_sha256"), "start", "n_chars", "probability", "is_secret")


# The tree of the mixture: sources fall in three domains by their number.
MIX_SOURCE = "CAST(coalesce(nullif(regexp_extract(source, '([0-9]+)$', 1), ''), '0') AS INT)"
MIX_DOMAIN = f"CASE {MIX_SOURCE} % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'books' ELSE 'code' END"
MIX_WEIGHTS = {
    "domain": f"CASE {MIX_SOURCE} % 3 WHEN 0 THEN 5 WHEN 1 THEN 3 ELSE 2 END",
    "lang": "CASE lang WHEN 'en' THEN 6 WHEN 'fr' THEN 2 WHEN 'de' THEN 2 ELSE 1 END",
    "source": f"1 + {MIX_SOURCE} % 4",
}


def mixture(docs: DataFrame) -> DataFrame:
    """The mixture of query and pipeline: as many tokens as the documents hold, at most four epochs of a source."""
    weights = {k: F.expr(v) for k, v in MIX_WEIGHTS.items()}
    return mixing.mixed(docs, F.expr(MIX_DOMAIN), F.col("lang"), F.col("source"), weights, share=1.0, epochs=4, seed=1)


def _level_sql(depth: int) -> str:
    """SQL of one level of budgets: ``given<depth>`` from the leaves and the level above."""
    path, above = ["domain", "lang", "source"][: depth + 1], ["domain", "lang", "source"][:depth]
    cols, by = ", ".join(path), f"PARTITION BY {', '.join(above)} " if above else ""
    source = f"leaves JOIN given{depth - 1} USING ({', '.join(above)})" if above else "leaves, total"
    return f"""
nodes{depth} AS (SELECT {cols}, sum(room)::BIGINT AS cap, any_value(w{depth})::BIGINT AS w, any_value(given)::BIGINT AS b
  FROM {source} WHERE room > 0 GROUP BY {cols}),
rates{depth} AS (SELECT *, (b - coalesce(sum(cap) OVER ({by}ORDER BY cap / w, {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / (sum(w) OVER ({by}ORDER BY cap / w, {path[-1]} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rate FROM nodes{depth}),
given{depth} AS (SELECT {cols}, greatest(0, least(cap, floor(max(rate) OVER ({by.strip()}) * w + 1e-6)::BIGINT)) AS given FROM rates{depth})"""


_MIX_SQL = rf"""
WITH rows AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {MIX_DOMAIN} AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens,
    {MIX_WEIGHTS['domain']} AS w0, {MIX_WEIGHTS['lang']} AS w1, {MIX_WEIGHTS['source']} AS w2
  FROM documents),
leaves AS (SELECT domain, lang, source, max(w0) AS w0, max(w1) AS w1, max(w2) AS w2, sum(n_tokens)::BIGINT AS tokens, (4 * sum(n_tokens))::BIGINT AS room
  FROM rows GROUP BY domain, lang, source),
total AS (SELECT sum(tokens)::BIGINT AS given FROM leaves),
{_level_sql(0)},
{_level_sql(1)},
{_level_sql(2)},
plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS epochs,
    given - CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END * tokens AS rest FROM leaves JOIN given2 USING (domain, lang, source)),
placed AS (SELECT *, substr(md5('1:' || epochs::VARCHAR || ':' || doc_id::VARCHAR), 1, 15) AS u FROM rows JOIN plan USING (domain, lang, source)),
past AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY u, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS past FROM placed)
SELECT doc_id, domain, lang, source, n_tokens,
  CASE WHEN n_tokens > 0 THEN epochs + CASE WHEN past <= rest THEN 1 ELSE 0 END ELSE 0 END::BIGINT AS copies FROM past"""


@query(_MIX_SQL)
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mixture holds each document."""
    out = mixture(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    return out.select("doc_id", F.col("__domain").alias("domain"), F.col("__lang").alias("lang"), F.col("__source").alias("source"), "n_tokens", "copies")


# The plain definition: every item laid over every document at every place where enough tokens are equal.
_DECONTAM_SQL = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w, generate_subscripts(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), 1) AS p FROM documents),
b AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w, generate_subscripts(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), 1) AS p FROM benchmark),
items AS (SELECT item_id, count(*) AS n, least(count(*), 16) AS width, CASE WHEN count(*) < 12 THEN count(*) ELSE ceil(0.8 * least(count(*), 16)) END AS need FROM b GROUP BY item_id),
lengths AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
equal AS (SELECT doc_id, item_id, d.p - b.p AS shift, b.p FROM d JOIN b USING (w)),
offsets AS (SELECT doc_id, item_id, shift, count(*) AS hits FROM equal GROUP BY doc_id, item_id, shift),
laid AS (SELECT doc_id, item_id, shift, width, need, greatest(1, 1 - shift) AS low, least(items.n, lengths.n - shift) AS high
  FROM offsets JOIN items USING (item_id) JOIN lengths USING (doc_id) WHERE hits >= need),
starts AS (SELECT DISTINCT doc_id, item_id, shift, width, need, least(p, high - width + 1) AS s FROM laid JOIN equal USING (doc_id, item_id, shift) WHERE high - low + 1 >= width),
runs AS (SELECT doc_id, item_id, shift, s, any_value(need) AS need, count(*) AS overlap FROM starts JOIN equal USING (doc_id, item_id, shift)
  WHERE p BETWEEN s AND s + width - 1 GROUP BY doc_id, item_id, shift, s)
SELECT doc_id, item_id, max(overlap)::INT AS overlap FROM runs WHERE overlap >= need GROUP BY doc_id, item_id"""


@query(_DECONTAM_SQL)
def op7_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with every benchmark item that overlaps it in 13 of 16 neighbouring tokens."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The pages carry no dates and there is no list table: fetch times follow from the page's id, and the
# list's dated entries from digests of the hosts that the pages have.
_FETCHED = "timestampadd(MINUTE, CAST(page_id * 7919 % 525600 AS INT), timestamp_ntz'2024-01-01 00:00:00')"
# (key, smallest digest remainder, modulus, action, days after the digest's day)
_ENTRIES = (
    ("host", 0, 3, "block", 0), ("host", 0, 6, "remove", 60), ("host", 0, 12, "block", 120),
    ("domain", 1, 2, "block", 30), ("domain", 1, 2, "remove", 90), ("section", 0, 5, "allow", 10), ("section", 0, 10, "block", 200),
)


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries ``(key, action, at)`` derived from the hosts, parent domains and first path parts of pages."""
    host = urls.url_host(F.col("url"))
    section = F.concat(host, F.regexp_extract(urls.url_path(F.col("url")), "^(/[^/]+)", 1))
    kinds = {"host": host, "domain": F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), "section": section}
    named = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in kinds.items()]))
    keys = pages.select(named.alias("k")).select("k.*").filter("key IS NOT NULL").distinct()
    keys = keys.withColumn("digest", F.conv(F.substring(F.md5("key"), 1, 6), 16, 10).cast("int"))
    entry = lambda kind, remainder, modulus, action, days: F.when(
        (F.col("kind") == kind) & (F.col("digest") % modulus == remainder), F.struct(F.lit(action).alias("action"), F.lit(days).alias("days")))
    chosen = F.explode(F.filter(F.array(*[entry(*e) for e in _ENTRIES]), lambda e: e.isNotNull()))
    at = F.expr("timestampadd(DAY, digest % 150 + e.days, timestamp_ntz'2024-01-01 00:00:00')").alias("at")
    return keys.withColumn("e", chosen).select("key", "e.action", at)


def _url_sql() -> str:
    pick = " UNION ALL ".join(
        f"SELECT key, '{action}' AS action, TIMESTAMP '2024-01-01' + to_days((digest % 150 + {days})::INT) AS since FROM keys WHERE kind = '{kind}' AND digest % {modulus} = {remainder}"
        for kind, remainder, modulus, action, days in _ENTRIES)
    return rf"""
WITH p AS (SELECT page_id, url, TIMESTAMP '2024-01-01' + to_minutes((page_id * 7919 % 525600)::INT) AS fetched_at,
    nullif(regexp_replace(regexp_extract(lower(trim(url)), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)', 1), '\.+$', ''), '') AS host,
    regexp_replace(regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1), '/+$', '') AS path FROM pages),
named AS (SELECT DISTINCT kind, key FROM (
  SELECT 'host' AS kind, host AS key FROM p UNION ALL SELECT 'domain', regexp_extract(host, '([^.]+\.[^.]+)$', 1) FROM p
  UNION ALL SELECT 'section', host || regexp_extract(path, '^(/[^/]+)', 1) FROM p) WHERE key IS NOT NULL),
keys AS (SELECT *, ('0x' || substr(md5(key), 1, 6))::INT AS digest FROM named),
entries AS (SELECT key, max(action) AS action, since FROM ({pick}) GROUP BY key, since),
spans AS (SELECT *, lead(since) OVER (PARTITION BY key ORDER BY since) AS until FROM entries),
asked AS (SELECT page_id, fetched_at, host, string_split(host, '.') AS l, string_split(path, '/') AS s FROM p),
looks AS (
  SELECT page_id, fetched_at, unnest(range(1, len(l) + 1)) AS rank, array_to_string(l[len(l) - rank + 1 :], '.') AS key FROM asked WHERE host IS NOT NULL
  UNION ALL
  SELECT page_id, fetched_at, 1000000 + unnest(range(1, len(s))) + 0 AS rank, host || array_to_string(s[: rank - 1000000 + 1], '/') AS key FROM asked WHERE host IS NOT NULL AND len(s) > 1),
met AS (SELECT page_id, action, key, since, row_number() OVER (PARTITION BY page_id ORDER BY rank DESC) AS k FROM looks JOIN spans USING (key)
  WHERE action <> 'remove' AND since <= fetched_at AND (until IS NULL OR fetched_at < until))
SELECT page_id, url, fetched_at, coalesce(action = 'block', false) AS blocked, key AS matched_key, since FROM p LEFT JOIN (SELECT * FROM met WHERE k = 1) USING (page_id)"""


@query(_url_sql())
def op8_temporal_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the list entry in force when it was fetched."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judged(pages.withColumn("fetched_at", F.expr(_FETCHED)), list_entries(pages))


@query()
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 3-word shingles, linked at two or fewer differing bits."""
    found = simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, threshold=2)
    return found.withColumn("fingerprint", F.lower(F.hex("fingerprint")))


@query()
def op10_collision_counting_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label with cosine 0.93 or more."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.93)


def _phrase_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS l FROM pieces),
totals AS (SELECT lang, sum(len(l))::BIGINT AS n FROM cut GROUP BY lang),
grams AS (SELECT lang, unnest(l) AS phrase, 1 AS size FROM cut
  UNION ALL SELECT lang, unnest([l[i] || ' ' || l[i + 1] FOR i IN range(1, len(l))]), 2 FROM cut
  UNION ALL SELECT lang, unnest([l[i] || ' ' || l[i + 1] || ' ' || l[i + 2] FOR i IN range(1, len(l) - 1)]), 3 FROM cut),
counts AS (SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY lang, phrase, size HAVING count(*) >= 10),
cuts AS (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM counts WHERE size > 1),
parts AS (SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, (1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ') JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
worst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM parts) WHERE o = 1),
inside AS (SELECT lang, phrase, max(f) AS longer FROM (
  SELECT lang, f, array_to_string(w[1:2], ' ') AS phrase FROM cuts WHERE size = 3 UNION ALL SELECT lang, f, array_to_string(w[2:3], ' ') FROM cuts WHERE size = 3) GROUP BY lang, phrase),
ranked AS (SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
  FROM worst w LEFT JOIN inside i ON i.lang = w.lang AND i.phrase = w.phrase WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


@query(_phrase_sql())
def op11_son_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    known = licenses.filed(licenses.PHRASES, licenses.TEMPLATES, 0.8, {})
    rows = ", ".join(
        f"({t}, '{f.label}', {f.base}, {len(f.words)}, {f.need}, {len(f.keys)}, {k}, '{w}', {k in f.keys})" for t, f in enumerate(known) for k, w in enumerate(f.words))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS l FROM documents),
w AS (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) - 1 AS p FROM d),
known(t, label, base, size, need, keys, k, word, is_key) AS (VALUES {rows}),
met AS (SELECT doc_id, t, any_value(label) AS label, any_value(base) AS base, p - k AS start, count(*) / any_value(size) AS score
  FROM w JOIN known USING (word) GROUP BY doc_id, t, p - k HAVING count(*) >= any_value(need) AND count(*) FILTER (is_key) = any_value(keys)),
found AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM met GROUP BY doc_id)
SELECT doc_id, len(l) AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score FROM d LEFT JOIN found USING (doc_id)"""


@query(_license_sql())
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and passages of every document."""
    return licenses.license_report(table(spark, sf_dir, "documents"))


@query()
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 32 strongest components, whitened."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=32)
