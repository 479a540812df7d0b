"""Registered queries of the training-data operators and their DuckDB SQL.

Each query applies its operator, with production parameters, to a whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.llm import colloc, decontam, langid, packing, pii, quality, rules, search, sharding, simhash, toxicity, urlfilter, warc
from comptoir.llm._util import held_out, table

CAPACITY = 1024
SIMHASH = {"shingle": 3, "radius": 2}
WARC_SPLIT = 4 << 20
SHARDS = 24

URL_RULES = [
    urlfilter.UrlRule("com", "/", "allow"),
    urlfilter.UrlRule("example.com", "/en/", "block"),
    urlfilter.UrlRule("www.example.com", "/en/", "allow"),
    urlfilter.UrlRule("net", "/es/", "block"),
    urlfilter.UrlRule("net", "/fr/", "block"),
]
# Words in a host label that put a site's pages on the block list.
LISTED_WORDS = ("adult", "porn", "xxx", "bets", "betting", "casino", "gambling", "poker", "malware", "phishing", "warez")
LISTED_HOST = rf"(^|[.-])({'|'.join(LISTED_WORDS)})([.-]|$)"


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), CAPACITY, keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = warc.round_trip(table(spark, sf_dir, "pages"), WARC_SPLIT)
    whole = F.col("record_type") == "response"
    return r.select(
        F.col("headers")["page-id"].cast("long").alias("page_id"),
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("http_headers")["content-length"].cast("long")).alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", F.col("headers")["refers-to-page-id"].cast("long").alias("refers_to"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def listed_keys(pages: DataFrame) -> DataFrame:
    """The block list as a table of keys: all pages of listed hosts."""
    host, path = urlfilter.host_of(F.col("url")), urlfilter.path_of(F.col("url"))
    return pages.select(F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path")).where(
        F.col("host").rlike(LISTED_HOST)).select(urlfilter.page_key(F.col("host"), F.col("path")).alias("key"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = urlfilter.host_of(F.col("url")), urlfilter.path_of(F.col("url"))
    keys = pages.select(urlfilter.page_key(F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))).alias("key"))
    return urlfilter.judge(pages, urlfilter.Cascades.build(keys, listed_keys(pages)), URL_RULES).drop("url")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "evidence")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, quality.fit(docs))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    p = langid.predict(docs, langid.fit(docs))
    return p.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"), **SIMHASH)
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.key_of(spark)).select("doc_id", "text", "pii")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = search.Index.build(table(spark, sf_dir, "documents"))
    return search.search(index, table(spark, sf_dir, "benchmark"), top=10)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return colloc.collocations(table(spark, sf_dir, "documents"), least=100, top=2000)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_best_fit_packing, op2_warc, op3_decontamination, op4_url_filter, op5_toxicity, op6_quality_classifier,
    op7_language_id, op8_quality_rules, op9_simhash, op10_pii, op11_ranked_search, op12_sharding, op13_collocations, pipeline)}

_W = r"[^\x20\x09-\x0D]"
_STOPS = ", ".join(repr(x) for x in sorted({x for lang in rules.STOP_WORDS for w in lang.split() for x in (w, w.capitalize())}))


def _op8_sql() -> str:
    table_rules = " AND ".join(
        f"{r.measure} >= {r.low}" if r.high is None else f"{r.measure} <= {r.high}" if r.low is None else f"{r.measure} BETWEEN {r.low} AND {r.high}"
        for r in rules.RULES)
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '{_W}+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_W}')) AS lines FROM t),
g AS (SELECT *, CASE WHEN len(words) >= 8 THEN list_transform(range(1, len(words) - 6), lambda i: array_to_string(words[i:i + 7], ' ')) ELSE [] END AS windows FROM w),
e AS (SELECT doc_id, unnest(windows) AS win, unnest(range(0, len(windows))) AS pos FROM g),
d AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, win) AS n FROM e),
c AS (SELECT doc_id, pos, lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM d WHERE n > 1),
r AS (SELECT doc_id, sum(least(8, coalesce(nxt, pos + 8) - pos)) AS n_repeat FROM c GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS marks,
             len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
             len(list_filter(words, lambda x: x IN ({_STOPS}))) AS stops,
             len(list_filter(lines, lambda x: ends_with(rtrim(x), '...') OR ends_with(rtrim(x), '…'))) AS ellipsis,
             len(list_filter(lines, lambda x: regexp_matches(ltrim(x), '^[-*•]'))) AS bullets
      FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
s AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END AS mean_word_chars,
             CASE WHEN n_words > 0 THEN n_symbols::DOUBLE / n_words ELSE 0 END AS symbols_per_word,
             CASE WHEN n_words > 0 THEN marks::DOUBLE / n_words ELSE 0 END AS marks_per_word,
             CASE WHEN n_words > 0 THEN stops::DOUBLE / n_words ELSE 0 END AS stop_word_share,
             CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS dup_line_share,
             CASE WHEN n_lines > 0 THEN ellipsis::DOUBLE / n_lines ELSE 0 END AS ellipsis_line_share,
             CASE WHEN n_lines > 0 THEN bullets::DOUBLE / n_lines ELSE 0 END AS bullet_line_share,
             (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, (NOT base_failed AND {table_rules}) AS kept FROM s
"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


O: dict[str, str] = {
    "op2_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS digest FROM p),
f AS (SELECT digest, max(page_id) AS response_id FROM d WHERE n >= 1000 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN response_id IS NULL OR page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response_id THEN response_id END AS refers_to
FROM d LEFT JOIN f ON d.digest = f.digest AND n >= 1000
""",
    "op4_url_filter": f"""
WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
r(rhost, rpath, rverdict) AS (VALUES {', '.join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)}),
m AS (SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(rverdict, length(rhost || rpath)) AS rverdict
      FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT h.page_id, host, path, rule, coalesce(rverdict, CASE WHEN regexp_matches(host, '{LISTED_HOST}') THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN m ON h.page_id = m.page_id
""",
    "op8_quality_rules": _op8_sql(),
    "op11_ranked_search": rf"""
WITH t AS (SELECT doc_id, row_number() OVER () AS d, regexp_extract_all({_LOWER.format('text')}, '{_TERM}') AS ts FROM documents),
s AS (SELECT count(*)::HUGEINT AS big_n, sum(len(ts))::HUGEINT AS big_l FROM t WHERE len(ts) > 0),
q AS (SELECT item_id, row_number() OVER () AS qi, unnest(regexp_extract_all({_LOWER.format('text')}, '{_TERM}')) AS term FROM benchmark),
o AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(ts) AS term FROM t) x WHERE term IN (SELECT term FROM q) GROUP BY d, term),
f AS (SELECT term, count(*) AS df FROM o GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM f, s),
m AS (SELECT d, doc_id, (25 + (75 * len(ts)::HUGEINT * big_n) // big_l)::BIGINT AS m FROM t, s WHERE len(ts) > 0),
r AS (SELECT qi, item_id, d, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN o USING (term) JOIN m USING (d) GROUP BY qi, item_id, d),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY qi ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r JOIN m USING (d) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10
""",
    "op13_collocations": rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, range(1, 6) x(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE k > 1),
u AS (SELECT lang, k, phrase, a, j, array_to_string(ws[1:j], ' ') AS p1, array_to_string(ws[j + 1:], ' ') AS p2 FROM c, range(1, 5) x(j) WHERE j < k),
s AS (SELECT u.*, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
      FROM u JOIN f x ON x.lang = u.lang AND x.phrase = p1 JOIN f y ON y.lang = u.lang AND y.phrase = p2 JOIN n ON n.lang = u.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (SELECT lang, array_to_string(ws[b0:b0 + sz - 1], ' ') AS phrase, max(a) AS around
      FROM c, range(2, 5) x(sz), range(1, 5) y(b0) WHERE sz < k AND b0 + sz - 1 <= k GROUP BY ALL),
z AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
      FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE around IS NULL OR 100 * around < 100 * a)
SELECT lang, rank::INTEGER AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM z WHERE rank <= 2000
""",
}
