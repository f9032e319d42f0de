"""Spelling variants: words one inserted, deleted or replaced code point apart, found by their rarest positional bigrams.

One edit spoils at most two bigrams of a word. With the bigrams of every word in one global order (rarest first, then by letters, then by
position) two near words share one of their three first bigrams, at the same place if they are equally long, else at the same or the next
place of the longer one. So words are joined by (bigram, place, length) of three bigrams each, together with what a
single edit must leave equal around the bigram, and what meets is verified. The order is that of the
bigrams' own frequencies: an insertion moves later places, so counts by place would not order both words alike.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terminus.llm.common import BATCH_NUMBERS, materialize

#: Code points and occurrences that a word needs; how many times as frequent its form is.
LEAST, SEEN, TIMES = 7, 2, 10
#: Letters of words; bigrams of the prefix, for one edit.
LETTERS, PREFIX = "A-Za-zÀ-ÿ", 3
#: In a run of a document whose checksum this divides one letter is left out.
THINNED = 31


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words with enough code points and occurrences. Shorter runs can't become words, so they are never taken out of a text."""
    own = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{LEAST},}}"), F.lit(0))).alias("run"))
    own = own.select("doc", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    own = own.withColumn("h", F.crc32(F.encode(F.concat("doc", F.lit(":"), "run"), "UTF-8"))).withColumn("at", (F.col("h") % F.length("run")).cast("int"))
    cut = F.concat(F.substring("run", F.lit(1), F.col("at")), F.substring("run", F.col("at") + 2, F.length("run")))
    own = own.select(F.when(F.col("h") % THINNED == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= LEAST)
    return own.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SEEN)


def prefixes(words: DataFrame) -> DataFrame:
    """(word, n, size, gram, place): the rarest bigrams of each word in the global order.

    Words have 90 letters, so there are at most 8,100 bigrams: their counts are small enough to broadcast at any size of the corpus."""
    places = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.struct(F.substring("word", i, F.lit(2)).alias("gram"), i.alias("place")))
    grams = words.select("word", "n", F.explode(places).alias("g")).select("word", "n", "g.*")
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    first = F.slice(F.array_sort(F.collect_list(F.struct("often", "gram", "place"))), 1, PREFIX)
    own = grams.join(F.broadcast(often), "gram").groupBy("word", "n").agg(first.alias("first"))
    return own.select("word", "n", F.length("word").alias("size"), F.explode("first").alias("g")).select("word", "n", "size", "g.gram", "g.place")


def keys(longer: int) -> Column:
    """What a word agrees on with a near one around a bigram that they share, a number for each case; `longer`: this word is so much longer than the other.

    The edit stands behind the bigram, then all up to it is equal, or before it, then all from it on is; the side with the edit, cut in two in the middle of the
    shorter word's, has one equal half as well. Numbers that two words share by chance are harmless, since what meets is verified."""
    word, place, size = F.col("word"), F.col("place"), F.col("size") - longer
    piece = lambda first, n: F.substring(word, first, F.greatest(n, F.lit(0)))
    half = lambda n: F.floor(n / 2).cast("int")
    behind, before = size - place - 1, place - longer - 1
    upto, onward = piece(F.lit(1), place + 1), piece(place, F.col("size"))
    cases = (
        (behind, place, upto, piece(place + 2, half(behind))),
        (behind, place, upto, piece(F.col("size") - (behind - half(behind)) + 1, behind - half(behind))),
        (before, place - longer, onward, piece(F.lit(1), half(before))),
        (before, place - longer, onward, piece(place - (before - half(before)), before - half(before))),
    )
    return F.array_compact(F.array(*[F.when(n >= 0, F.xxhash64(F.lit(i), size, at, a, b)) for i, (n, at, a, b) in enumerate(cases)]))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb): each pair of words that differ by exactly one edit, once; b is longer, or as long and later."""
    own = materialize(prefixes(words), "prefixes", rows=BATCH_NUMBERS)
    short = own.select(F.col("word").alias("a"), F.col("n").alias("na"), F.explode(keys(0)).alias("key"))
    long = own.select(F.col("word").alias("b"), F.col("n").alias("nb"), F.explode(F.concat(keys(0), keys(1))).alias("key"))
    fits = ((F.length("a") < F.length("b")) | (F.length("a") == F.length("b")) & (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    met = short.alias("s").join(long.alias("l"), [F.col("s.key") == F.col("l.key"), fits])
    return met.select("a", "na", "b", "nb").distinct()


def forms(pairs: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n): the number of near words, and the most frequent one (of equals the smallest) where it is frequent enough."""
    both = pairs.select(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("other"), F.col("nb").alias("m"))
    both = both.union(pairs.select("b", "nb", "a", "na"))
    best = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    fits = -F.col("best.m") >= TIMES * F.col("n")
    return best.select("word", "n_near", F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.m")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """links (word, form): (word, root), the last form that a word leads to. Each form is ten times as frequent as the word, so a chain has fewer
    links than the largest count has digits; each round doubles what a row has followed."""
    own = materialize(links.select("word", F.col("form").alias("root")), "roots", rows=BATCH_NUMBERS)
    while True:
        ahead = own.select(F.col("word").alias("mid"), F.col("root").alias("end"))
        own = materialize(own.join(ahead, F.col("root") == F.col("mid"), "left").select("word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")), "roots", rows=BATCH_NUMBERS)
        if own.where("moved").isEmpty():
            return own.select("word", "root")
        own = own.drop("moved")


def group(docs: DataFrame) -> DataFrame:
    """Every word of the corpus with its form and root.

    docs: doc_id, text; further columns are not read. A null text has no words; a null doc_id counts as an empty one in the checksum. Repeated rows
    count each. Texts and words may have any length. An empty table gives no rows. Of near words with equal counts the smallest in code-point order
    is the form; a word without form is its own root."""
    words = materialize(vocabulary(docs), "words", rows=BATCH_NUMBERS)
    found = materialize(forms(near_pairs(words)), "forms", rows=BATCH_NUMBERS)
    ends = roots(found.where("form IS NOT NULL"))
    out = words.join(found, "word", "left").join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def oracle() -> str:
    """The same rows in DuckDB's SQL: near words meet under what is left of them without one letter."""
    return f"""
    WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda v: list_reduce(list_prepend(v, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{{LEAST},}}')), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run FROM documents),
    c AS (SELECT doc, run, count(*) AS k FROM r GROUP BY ALL),
    b AS (SELECT run, k, flatten(list_transform(string_split(doc || ':' || run, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [(192 | (ord(x) >> 6))::BIGINT, (128 | (ord(x) & 63))::BIGINT] END)) AS bytes FROM c),
    h AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) AS h FROM b, tab),
    w AS (SELECT CASE WHEN h % {THINNED} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(k)::BIGINT AS n FROM h GROUP BY 1 HAVING length(word) >= {LEAST} AND sum(k) >= {SEEN}),
    holes AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
    cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM holes),
    near AS (SELECT x.word, x.n, y.word AS other, y.n AS m FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
      UNION SELECT x.word, x.n, y.word, y.n FROM cut x JOIN w y ON x.rest = y.word UNION SELECT y.word, y.n, x.word, x.n FROM cut x JOIN w y ON x.rest = y.word),
    best AS (SELECT word, n, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, other)) AS other FROM near GROUP BY ALL),
    link AS (SELECT word, n_near, CASE WHEN m >= {TIMES} * n THEN other END AS form, CASE WHEN m >= {TIMES} * n THEN m END AS form_n FROM best),
    way AS (SELECT word, word AS root FROM w UNION ALL SELECT way.word, link.form FROM way JOIN link ON link.word = way.root WHERE link.form IS NOT NULL),
    ends AS (SELECT way.word, way.root FROM way LEFT JOIN link ON link.word = way.root WHERE link.form IS NULL)
    SELECT word, form, root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n::BIGINT AS form_n FROM w LEFT JOIN link USING (word) JOIN ends USING (word)"""
