"""Personal data by bootstrapped contextual extraction; DataFrame and SQL functions only.

Seeds are what the fixed expressions find: addresses of mail, of hosts, cards, phones. The one to three words in front of a seed are lexical
patterns. Whatever looks somewhat like such an identifier, but isn't found by the expressions (a host written (at), a phone without its +, a
card number with a slip), is a candidate; all other words with a digit or an @ count against a pattern that stands before them too. Patterns and distinct values
make a graph, which is scored in rounds: a pattern is as good as the part of its values that are known, a candidate is known once the patterns
before it leave little doubt, and known candidates make further patterns good. It ends when a round finds nothing new. Values found that way are
marked wherever they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terminus.llm.common import BATCH_NUMBERS, dropped, materialize

KINDS = ("email", "ip", "card", "phone")
# The expressions of each kind. Those searched are the same ones, begun only where a leftmost match can begin and never backtracking, so long runs
# of letters or digits stay linear; of cards only chains of 14 to 19 digits are taken up.
BASE = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: Any of them. After a match of another kind none begins within a word, where the rest of a long run would be read again after each match.
ANY = "|".join(f"(?:{e})" for e in BASE).replace(r"|\G", "")
#: What may be an identifier of a kind where a pattern says so.
WIDE = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[\[(]at[\])] ?|@)[A-Za-z0-9-]++(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]++)*+",
    r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}+:){3,7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Za-z:])",
    r"(?<![0-9A-Za-z])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9]|[A-Za-z])",
    r"(?<![0-9A-Za-z.+-])(?<![0-9][ -])\(?[0-9](?:[ ().-]{0,2}[0-9]){6,14}+(?![ -]?[0-9]|[A-Za-z])",
)
#: Any word with a digit or an @.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: A text without these has neither; signs around a match and in place of one.
NEEDED = r"[0-9@]|[\[(]at[\])]"
MARK, BLANK = "\x01", "\x02"
#: Known values that a pattern needs, least part of its values that are known, least score of a candidate.
SUPPORT, CONFIDENCE, ACCEPT = 3, 0.6, 0.8
#: Words of a pattern at most; code points in front of a value in which they stand.
WORDS, REACH = 3, 80
#: Longer values are known by a digest.
KEY = 64
#: Matches of a text that are summed up at a time.
BLOCK = 256
SPAN = "struct<start:int,kind:int,end:int>"


def running(sizes: Column) -> Column:
    """Running sums of an array, in blocks: an array that grows in a fold is copied at each step."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")), lambda b: F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK)))
    add = lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + s))
    before = F.aggregate(F.transform(blocks, lambda x: F.aggregate(x, F.lit(0), lambda a, s: a + s)), F.array(F.lit(0)), add)
    sums = F.flatten(F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), lambda x, o: F.slice(F.aggregate(x, F.array(o), add), 2, BLOCK)))
    return F.when(F.size(sizes) > 0, sums).otherwise(F.array().cast("array<int>"))


def once(df: DataFrame) -> DataFrame:
    """The same rows; what the columns are made of is computed here, once a row. Merged into a later projection it would be computed again wherever it is
    named, within a lambda for every element."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_own")).select("_own.*")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    double = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    at = lambda i: F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), lambda a, i: a + F.when(i % 2 == 1, double(at(i))).otherwise(at(i)))
    return total % 10 == 0


def passes(kind: int, value: Column) -> Column:
    """Whether a match of a kind's expression counts."""
    if kind == 1:
        return value.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")
    if kind == 2:
        return F.length(digits(value)).between(14, 19) & luhn(digits(value))
    if kind == 3:
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


def right(kind: int, spans: Column) -> Column:
    """The spans of a kind whose values count."""
    return F.filter(spans, lambda s: passes(kind, s["value"]))


def any_passes(value: Column) -> Column:
    """The same of a match of any of them, told apart by what it holds."""
    return F.when(value.contains("@"), F.lit(True)).when(value.startswith("+"), passes(3, value)).when(value.contains("."), passes(1, value)).otherwise(passes(2, value))


def cut(text: Column | str, expression: str) -> Column:
    """A text as gaps and matches in turn, a gap first and last: (size, held), of a gap only its last REACH code points. One pass marks the matches; the mark is
    no character of the text."""
    parts = F.split(F.regexp_replace(text, expression, f"{MARK}$0{MARK}"), MARK, -1)
    return F.transform(parts, lambda p, i: F.struct(F.length(p).alias("size"), F.when(i % 2 == 1, p).otherwise(F.right(p, F.lit(REACH))).alias("held")))


def words_before(gap: Column) -> Column:
    """Up to WORDS words at the end of a gap, of its last line only; digits in them are all alike."""
    own = F.filter(F.split(F.regexp_replace(F.lower(F.substring_index(gap, "\n", -1)), "[0-9]+", "#"), r"\s+"), lambda w: w != "")
    return F.slice(own, F.greatest(F.size(own) - WORDS + 1, F.lit(1)), F.lit(WORDS))


def odd(parts: str) -> Column:
    """Places of the matches."""
    return F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: i % 2 == 1)


def placed(name: str, kind: int) -> Column:
    """The matches of a kind as (start, kind, end, value, words)."""
    part, end = (lambda i: F.get(F.col(name), i)), (lambda i: F.get(F.col(f"e_{name}"), i))
    return F.transform(odd(name), lambda i: F.struct((end(i) - part(i)["size"]).alias("start"), F.lit(kind).alias("kind"), end(i).alias("end"), part(i)["held"].alias("value"), words_before(part(i - 1)["held"]).alias("words")))


def matched(df: DataFrame, text: str, expressions: tuple, name: str) -> DataFrame:
    """The cuts of a text by each kind's expression, name_k, and their ends."""
    own = once(df.withColumns({f"{name}{k}": cut(text, e) for k, e in enumerate(expressions)}))
    own = once(own.withColumns({f"s_{name}{k}": F.transform(f"{name}{k}", lambda p: p["size"]) for k in range(len(expressions))}))
    return once(own.withColumns({f"e_{name}{k}": running(F.col(f"s_{name}{k}")) for k in range(len(expressions))}))


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, base, wide, events) of every row: spans, candidates' spans with their values, and what is told to the graph:
    (kind, known, value, words), kind -1 for words that are no identifier of ours. Texts that hold nothing that any of the expressions needs are passed over."""
    kinds = range(len(KINDS))
    text = F.translate(F.col("text").cast("string"), MARK, BLANK)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(text.rlike(NEEDED), text).otherwise(F.lit("")).alias("text"))
    own = matched(own, "text", BASE, "base")
    # What the expressions found is blanked, place for place, before candidates are looked for
    parts = F.split(F.regexp_replace("text", ANY, f"{MARK}$0{MARK}"), MARK, -1)
    rest = F.array_join(F.transform(parts, lambda p, i: F.when((i % 2 == 1) & any_passes(p), F.repeat(F.lit(BLANK), F.length(p))).otherwise(p)), "")
    own = once(own.select("doc_id", F.concat(*[right(k, placed(f"base{k}", k)) for k in kinds]).alias("base"), rest.alias("rest")))
    own = matched(own, "rest", WIDE, "wide")
    own = own.select("doc_id", "base", F.concat(*[placed(f"wide{k}", k) for k in kinds]).alias("wide"), cut(F.regexp_replace("rest", "|".join(f"(?:{e})" for e in WIDE), " "), TOKEN).alias("other"))
    own = once(own)
    key = lambda v: F.when(F.length(v) <= KEY, v).otherwise(F.sha2(F.encode(v, "UTF-8"), 256))
    event = lambda kind, known, v, w: F.struct(kind.alias("kind"), F.lit(known).alias("known"), key(v).alias("value"), w.alias("words"))
    events = F.concat(
        F.transform("base", lambda s: event(s["kind"], True, s["value"], s["words"])),
        F.transform("wide", lambda s: event(s["kind"], False, s["value"], s["words"])),
        F.transform(odd("other"), lambda i: event(F.lit(-1), False, F.get("other", i)["held"], words_before(F.get("other", i - 1)["held"]))),
    )
    spans = lambda c, *more: F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), *[key(s[m]).alias(m) for m in more]))
    return own.select("doc_id", spans("base").alias("base"), spans("wide", "value").alias("wide"), events.alias("events"))


def graph(rows: DataFrame) -> DataFrame:
    """(pattern, kind, value, known), each once: the last one to three words before a value."""
    own = rows.select(F.explode("events").alias("e")).select("e.*").where(F.size("words") > 0)
    ends = F.transform(F.sequence(F.lit(1), F.size("words")), lambda n: F.array_join(F.slice("words", -n, n), " "))
    return own.select(F.explode(ends).alias("pattern"), "kind", "value", "known").groupBy("pattern", "kind", "value").agg(F.bool_or("known").alias("known"))


def good_patterns(edges: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(pattern, kind, confidence): known values of a kind against them and all that is no candidate of the kind, and one more."""
    per = edges.groupBy("pattern", "kind").agg(F.count_if("known").alias("known"), F.count(F.lit(1)).alias("n"))
    every = per.groupBy("pattern").agg(F.sum("n").alias("every"))
    own = per.where((F.col("kind") >= 0) & (F.col("known") >= support)).join(every, "pattern")
    return own.select("pattern", "kind", (F.col("known") / (F.col("known") + F.col("every") - F.col("n") + 1)).alias("confidence")).where(F.col("confidence") >= confidence)


def accepted(edges: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, accept: float = ACCEPT) -> DataFrame | None:
    """(kind, value) of the candidates that patterns vouch for, or None. Patterns that end with the same word are one witness, the best of them."""
    have: DataFrame | None = None
    while True:
        now = edges if have is None else edges.join(have.withColumn("new", F.lit(True)), ["kind", "value"], "left").withColumn("known", F.col("known") | F.coalesce("new", F.lit(False))).drop("new")
        good = good_patterns(now, support, confidence)
        witness = now.where(~F.col("known") & (F.col("kind") >= 0)).join(good, ["pattern", "kind"]).groupBy("kind", "value", F.substring_index("pattern", " ", -1).alias("last")).agg(F.max("confidence").alias("c"))
        score = 1 - F.exp(F.sum(F.log(1 - F.col("c"))))
        new = materialize(witness.groupBy("kind", "value").agg(score.alias("score")).where(F.col("score") >= accept - 1e-9).select("kind", "value"), "accepted", rows=BATCH_NUMBERS)
        if new.isEmpty():
            dropped(new)
            return have
        have = new if have is None else have.union(new)


def listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, then end."""
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def extract(docs: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, accept: float = ACCEPT) -> DataFrame:
    """Every document with the number of base spans of each kind, their digest, and all spans, those that the method adds included.

    docs: doc_id, text; further columns are not read. A null text is empty: no spans, the digest of an empty string. Repeated rows are
    scanned each, and count as one value in the graph. A null doc_id stays. Texts may have any length; of a gap before a value the last REACH code points are read for patterns.
    A candidate never overlaps a base span; candidates of different kinds may overlap each other. An empty table gives no rows. Only whether a round found
    anything reaches the driver."""
    rows = materialize(found(docs).withColumn("row", F.monotonically_increasing_id()), "found")
    edges = materialize(graph(rows), "edges", rows=BATCH_NUMBERS)
    have = accepted(edges, support, confidence, accept)
    own = rows.select("row", "doc_id", "base").withColumn("more", F.array().cast(f"array<{SPAN}>"))
    if have is not None:
        hits = rows.select("row", "base", F.explode("wide").alias("s")).select("row", "base", "s.*").join(have, ["kind", "value"])
        free = ~F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))
        hits = hits.where(free).groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("hits"))
        own = own.join(hits, "row", "left").withColumn("more", F.coalesce("hits", "more"))
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return own.select("doc_id", *[number(k) for k in range(4)], F.sha2(F.encode(listed(F.col("base")), "UTF-8"), 256).alias("base_sha256"), listed(F.concat("base", "more")).alias("spans"))
