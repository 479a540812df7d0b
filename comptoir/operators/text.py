"""Review text analytics (TXT-01..04, AGG-13, SRT-05, PRJ-03).

Tokens are produced per row with ``regexp_extract_all(lower(text), '\\p{L}+')``
and exploded in the same task, so a document never leaves its partition.
Counting tokens aggregates with map-side combine (a very frequent token costs
one row per map task). The stop-word list and the sentiment lexicon are
input tables, equi-joined: Spark broadcasts them if it finds them small enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TOKEN_PATTERN = r"\p{L}+"

# Default stop words (common function words in French, English,
# German and Spanish); callers pass their own list or table.
DEFAULT_STOPWORDS = """
le la les un une des du de d l et ou en au aux ce ces cet cette il elle ils elles on nous vous je tu me te se
qui que quoi dont où ne pas plus par pour sur dans avec sans sous est sont été être avoir a ai as avons ont
son sa ses leur leurs mon ma mes ton ta tes notre nos votre vos y
the a an and or of to in on at by for with from as is are was were be been it its this that these those
he she they we you i not no but if then so than too very can will just
der die das den dem des ein eine einer und oder zu im in ist sind war nicht mit von auf für es er sie wir ich
el los las una unos unas y o que en es son por con para del al lo se su sus no
""".split()

# Default polarity lexicon (word, valence in [-1, 1]).
DEFAULT_LEXICON = [
    ("good", 0.7), ("great", 0.8), ("excellent", 1.0), ("love", 0.5), ("nice", 0.6), ("happy", 0.8),
    ("perfect", 1.0), ("best", 1.0), ("fast", 0.2), ("bad", -0.7), ("poor", -0.4), ("terrible", -1.0),
    ("awful", -1.0), ("worst", -1.0), ("slow", -0.3), ("broken", -0.4), ("hate", -0.8), ("wrong", -0.5),
    ("bon", 0.7), ("bonne", 0.7), ("parfait", 1.0), ("super", 0.8), ("rapide", 0.3),
    ("mauvais", -0.7), ("mauvaise", -0.7), ("nul", -0.8), ("lent", -0.3), ("cassé", -0.5),
    ("gut", 0.7), ("schlecht", -0.7), ("bueno", 0.7), ("buena", 0.7), ("malo", -0.7), ("mala", -0.7),
]

# Default modifiers. A negation turns the next valued word round and
# halves it; a degree word multiplies it.
DEFAULT_NEGATIONS = "not no never without hardly ne pas jamais sans nicht kein keine nie ohne nunca sin".split()
DEFAULT_DEGREES = [
    ("very", 1.3), ("really", 1.2), ("extremely", 1.5), ("so", 1.2), ("too", 1.1), ("slightly", 0.5), ("somewhat", 0.7),
    ("très", 1.3), ("vraiment", 1.2), ("trop", 1.1), ("peu", 0.5), ("sehr", 1.3), ("etwas", 0.7), ("muy", 1.3), ("poco", 0.5),
]
NEGATED = -0.5
REACH = 2  # other words that may stand between a modifier and what it modifies

# Polarity thresholds (strict inequalities).
POSITIVE_ABOVE = 0.1
NEGATIVE_BELOW = -0.1


def _require(df: DataFrame, cols) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; has {df.columns}")


def stopword_table(spark: SparkSession, words=None) -> DataFrame:
    words = DEFAULT_STOPWORDS if words is None else list(words)
    return spark.createDataFrame([(w,) for w in dict.fromkeys(words)], "token string")


def lexicon_table(spark: SparkSession, entries=None, negations=None, degrees=None) -> DataFrame:
    """(token, kind, value): kind is 'word' (a valence), 'negation' or 'degree' (a factor). The first entry of
    a token counts, words before negations before degrees."""
    words = DEFAULT_LEXICON if entries is None else list(entries)
    no = DEFAULT_NEGATIONS if negations is None else list(negations)
    by = DEFAULT_DEGREES if degrees is None else list(degrees)
    seen = {}
    for token, kind, value in ([(w, "word", v) for w, v in words] + [(w, "negation", NEGATED) for w in no] + [(w, "degree", v) for w, v in by]):
        seen.setdefault(token, (token, kind, float(value)))
    return spark.createDataFrame(list(seen.values()), "token string, kind string, value double")


def tokens_of(text) -> Column:
    """Alphabetic tokens, lower-cased, in order."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), F.lit(0))


def tokens_clean(docs: DataFrame, text: str = "comment", keep=("doc_id",), stopwords: DataFrame | None = None,
                 lemmas: DataFrame | None = None, pos_keep=("NOUN", "ADJ", "VERB")) -> DataFrame:
    """One row per kept token: (keep..., pos, token). NULL texts are skipped.

    ``lemmas`` (form, lemma, pos) optionally maps tokens to lemmas and keeps
    only the parts of speech in ``pos_keep`` (tokens absent from it are dropped).
    """
    _require(docs, [text, *keep])
    spark = docs.sparkSession
    sw = stopwords if stopwords is not None else stopword_table(spark)
    t = (docs.filter(F.col(text).isNotNull())
         .select(*keep, F.posexplode(tokens_of(text)).alias("pos", "token")))
    t = t.join(sw.select("token").distinct(), "token", "left_anti")
    if lemmas is not None:
        lx = lemmas.filter(F.col("pos").isin(list(pos_keep))).select(
            F.col("form").alias("token"), F.col("lemma"))
        t = t.join(lx, "token").withColumn("token", F.col("lemma")).drop("lemma")
    return t.select(*keep, "pos", "token")


def token_counts(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def top_tokens(tokens: DataFrame, k: int = 200) -> DataFrame:
    """The ``k`` most frequent tokens (ties by token) with weight = n / max n."""
    top = token_counts(tokens).orderBy(F.desc("n"), F.asc("token")).limit(k)
    return top.withColumn("weight", F.round(F.col("n") / F.max("n").over(Window.partitionBy()), 6))


def _fold(hits: Column) -> Column:
    """Mean value of the valued words of one text, from its lexicon hits in order of position. Modifiers
    gather until a valued word takes them up; they lapse when more than REACH other words follow."""
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n"), F.lit(1.0).alias("factor"), F.lit(1.0).alias("turn"), F.lit(-10).alias("at"))

    def step(acc: Column, h: Column) -> Column:
        near = h["pos"] - acc["at"] <= REACH + 1
        factor, turn = F.when(near, acc["factor"]).otherwise(1.0), F.when(near, acc["turn"]).otherwise(1.0)
        strength = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), h["value"] * factor))
        is_word = h["kind"] == "word"
        return F.struct(
            F.when(is_word, acc["total"] + strength * turn).otherwise(acc["total"]).alias("total"),
            F.when(is_word, acc["n"] + 1).otherwise(acc["n"]).alias("n"),
            F.when(is_word, 1.0).when(h["kind"] == "degree", factor * h["value"]).otherwise(factor).alias("factor"),
            F.when(is_word, 1.0).when(h["kind"] == "negation", F.lit(NEGATED)).otherwise(turn).alias("turn"),
            F.when(is_word, -10).otherwise(h["pos"]).alias("at"))

    return F.aggregate(hits, start, step, lambda s: F.when(s["n"] > 0, s["total"] / s["n"]).otherwise(0.0))


def polarity(docs: DataFrame, text: str = "comment", keep=("doc_id",), lexicon: DataFrame | None = None) -> DataFrame:
    """(keep..., polarity): one row per row of ``docs``; the mean value of the lexicon words in the text, with
    negations and degree words taken into account in reading order, 0.0 without hits.

    Tokens of a document are exploded inside its own task and gathered by the row's own number, so rows that
    share ``keep`` stay apart; only hits are kept on the way, and the partial aggregate collapses each
    document to one row before the shuffle. NULL text scores like the text 'nan' (no hits): 0.0. A
    ``lexicon`` of (token, valence) holds valued words only.
    """
    _require(docs, [text, *keep])
    lx = lexicon if lexicon is not None else lexicon_table(docs.sparkSession)
    if "kind" not in lx.columns:
        lx = lx.select("token", F.lit("word").alias("kind"), F.col("valence").cast("double").alias("value"))
    numbered = docs.select(*keep, tokens_of(F.coalesce(F.col(text), F.lit("nan"))).alias("__tokens"), F.monotonically_increasing_id().alias("__row"))
    t = numbered.select("__row", *keep, F.posexplode_outer("__tokens").alias("__pos", "token"))
    scored = t.join(lx.select("token", "kind", "value"), "token", "left")
    hit = F.when(F.col("kind").isNotNull(), F.struct(F.col("__pos").alias("pos"), "kind", "value"))
    per_row = scored.groupBy("__row", *keep).agg(F.sort_array(F.collect_list(hit)).alias("__hits"))
    return per_row.select(*keep, _fold(F.col("__hits")).alias("polarity"))


def classify(score) -> Column:
    """> 0.1 Positive, < -0.1 Negative, else Neutral (NULL score -> Neutral)."""
    s = F.col(score) if isinstance(score, str) else score
    return (F.when(s > POSITIVE_ABOVE, F.lit("Positive"))
            .when(s < NEGATIVE_BELOW, F.lit("Negative")).otherwise(F.lit("Neutral")))


def classify_sentiment(docs: DataFrame, text: str = "comment", keep=("doc_id", "asin"),
                       lexicon: DataFrame | None = None) -> DataFrame:
    p = polarity(docs, text, keep, lexicon)
    return p.withColumn("polarity", F.round("polarity", 6)).withColumn("sentiment", classify("polarity"))
