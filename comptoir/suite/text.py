"""Registered queries: review text analytics over ``fx_comments`` (documents)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import fx, with_fx
from ..operators import aggregates as A
from ..operators import text as TX

Q: dict = {}
O: dict = {}


def _comments(spark, sf):
    return fx(spark, sf, "fx_comments")


STOP_SQL = "(SELECT * FROM (VALUES " + ", ".join(f"('{w}')" for w in dict.fromkeys(TX.DEFAULT_STOPWORDS)) + ") s(token))"
_lex = {}
for _w, _k, _v in ([(w, "word", v) for w, v in TX.DEFAULT_LEXICON] + [(w, "negation", TX.NEGATED) for w in TX.DEFAULT_NEGATIONS]
                   + [(w, "degree", v) for w, v in TX.DEFAULT_DEGREES]):
    _lex.setdefault(_w, (_k, _v))
LEX_SQL = ("(SELECT * FROM (VALUES " + ", ".join(f"('{w}', '{k}', CAST({v} AS DOUBLE))" for w, (k, v) in _lex.items())
           + ") l(token, kind, value))")
TOKENS_CTE = ("toks AS (SELECT doc_id, CAST(unnest(range(len(t))) AS INTEGER) AS pos, unnest(t) AS token FROM "
              "(SELECT doc_id, regexp_extract_all(lower(comment), '\\p{L}+') AS t FROM fx_comments WHERE comment IS NOT NULL) x), "
              f"clean AS (SELECT * FROM toks WHERE token NOT IN (SELECT token FROM {STOP_SQL} s))")
# Runs of modifiers, by windows over the hits: a run ends after a valued word or a gap of more than REACH words.
POL_CTE = (
    "hits AS (SELECT doc_id, pos, kind, value FROM (SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS token FROM "
    "(SELECT doc_id, regexp_extract_all(lower(coalesce(comment, 'nan')), '\\p{L}+') AS t FROM fx_comments) x) y "
    f"JOIN {LEX_SQL} l ON y.token = l.token), "
    f"cut AS (SELECT *, CASE WHEN lag(kind) OVER w = 'word' OR pos - lag(pos) OVER w > {TX.REACH + 1} THEN 1 ELSE 0 END AS first "
    "FROM hits WINDOW w AS (PARTITION BY doc_id ORDER BY pos)), "
    "run AS (SELECT *, sum(first) OVER (PARTITION BY doc_id ORDER BY pos) AS nr FROM cut), "
    "word AS (SELECT doc_id, nr, greatest(-1.0, least(1.0, max(CASE WHEN kind = 'word' THEN value END) "
    "* coalesce(product(CASE WHEN kind = 'degree' THEN value END), 1.0))) "
    f"* CASE WHEN bool_or(kind = 'negation') THEN {TX.NEGATED} ELSE 1.0 END AS v FROM run GROUP BY doc_id, nr HAVING bool_or(kind = 'word')), "
    "sc AS (SELECT doc_id, avg(v) AS p FROM word GROUP BY doc_id), "
    "pol AS (SELECT d.doc_id, d.asin, round(coalesce(sc.p, 0.0), 6) AS polarity FROM fx_comments d LEFT JOIN sc ON d.doc_id = sc.doc_id), "
    "cls AS (SELECT *, CASE WHEN polarity > 0.1 THEN 'Positive' WHEN polarity < -0.1 THEN 'Negative' ELSE 'Neutral' END AS sentiment FROM pol)")


def q_tokens_clean(spark, sf):
    return TX.tokens_clean(_comments(spark, sf))


O["tokens_clean"] = with_fx(f"WITH {TOKENS_CTE} SELECT doc_id, pos, token FROM clean", "fx_comments")


def q_tokens_lemma(spark, sf):
    """Tokens mapped to lemmas; only nouns, adjectives and verbs of the lemma table are kept."""
    return TX.tokens_clean(_comments(spark, sf), lemmas=fx(spark, sf, "fx_lemmas"))


O["tokens_lemma"] = with_fx(
    f"WITH {TOKENS_CTE} SELECT doc_id, clean.pos AS pos, lemma AS token FROM clean JOIN fx_lemmas m ON clean.token = m.form "
    "WHERE m.pos IN ('NOUN', 'ADJ', 'VERB')", "fx_comments", "fx_lemmas")


def q_token_counts(spark, sf):
    return TX.token_counts(TX.tokens_clean(_comments(spark, sf)))


O["token_counts"] = with_fx(f"WITH {TOKENS_CTE} SELECT token, count(*) AS n FROM clean GROUP BY token", "fx_comments")


def q_top_tokens(spark, sf):
    return TX.top_tokens(TX.tokens_clean(_comments(spark, sf)), 200)


O["top_tokens"] = with_fx(
    f"WITH {TOKENS_CTE}, c AS (SELECT token, count(*) AS n FROM clean GROUP BY token ORDER BY n DESC, token LIMIT 200) "
    "SELECT token, n, round(n / max(n) OVER (), 6) AS weight FROM c", "fx_comments")


def q_polarity_score(spark, sf):
    return TX.polarity(_comments(spark, sf), keep=("doc_id", "asin")).withColumn("polarity", F.round("polarity", 6))


O["polarity_score"] = with_fx(f"WITH {POL_CTE} SELECT doc_id, asin, polarity FROM pol", "fx_comments")


def q_classify_sentiment(spark, sf):
    return TX.classify_sentiment(_comments(spark, sf))


O["classify_sentiment"] = with_fx(f"WITH {POL_CTE} SELECT doc_id, asin, polarity, sentiment FROM cls", "fx_comments")


def q_sentiment_by_asin(spark, sf):
    """The (asin, sentiment) file written for the warehouse: one row per comment."""
    return TX.classify_sentiment(_comments(spark, sf)).select("asin", "sentiment")


O["sentiment_by_asin"] = with_fx(f"WITH {POL_CTE} SELECT asin, sentiment FROM cls", "fx_comments")


def q_comment_sentiment_counts(spark, sf):
    return A.value_counts(TX.classify_sentiment(_comments(spark, sf)), "sentiment")


O["comment_sentiment_counts"] = with_fx(
    f"WITH {POL_CTE} SELECT sentiment, count(*) AS count FROM cls GROUP BY sentiment", "fx_comments")

for _k, _v in list(globals().items()):
    if _k.startswith("q_"):
        Q[_k[2:]] = _v
