"""Personal data: fixed patterns, and bootstrapped extraction by context.

The fixed patterns find emails, IP addresses, card and phone numbers with
their places.  They are the seed entities of a bootstrap: the two words before
an identifier-like token (one with a digit or an @) are a lexical pattern, in
which another such token stands as a placeholder, and so does the start of the
text.  Patterns and tokens form a graph.  A pattern is as good as its instances are
known to be personal, a token as good as the patterns that hold it; both are
scored in turn for a few rounds.  Patterns of high confidence then give every
token that they hold, also of kinds that no fixed pattern knows.

Everything is DataFrame functions; no Python runs in a task.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.scratch import materialize

#: Kinds found by fixed patterns, in the order of results.
KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"

# Fixed patterns.  Repetitions are possessive where nothing after them could
# take a part back, which keeps long runs from being tried again and again;
# the look-behind starts a run at its first character or where a match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
#: Tokens that may be identifiers.
CANDIDATE = r"(?<!\S)(?=\S*?[0-9@])\S++"
#: Tokens that are seeds beside the fixed patterns: long keys in hexadecimal.
KEY = r"^\W*[0-9a-f]{32,}\W*$"
#: Words before a token that make the pattern.
WORDS_BEFORE = r"(?<!\S)(\S++\s++\S++)\s++\z"
#: In patterns, an identifier-like token and the start of the text; no word looks like them, as each would be a token itself.
IDENTIFIER, START = "@", "0"
#: Longer patterns go by their digest.
LONG_PATTERN = 128

ROUNDS = 3
#: Different tokens that a pattern must hold, and the confidence it must reach.
LEAST_INSTANCES = 5
CONFIDENT = 0.8

#: Put around matches; it is taken out of the text before, one character for one.
_MARK, _STAND_IN = "\x01", "\x02"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


_BLOCK = 256


def _starts(parts: Column) -> Column:
    """Offset in code points of every odd part; sums are taken by blocks so that many parts stay cheap."""

    def of(lengths: Column) -> Column:
        n = F.size(lengths)
        blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")), lambda b: _sum(F.slice(lengths, b * _BLOCK + 1, _BLOCK)))
        before = lambda sums: F.transform(F.sequence(F.lit(0), F.size(sums) - 1), lambda b: _sum(F.slice(sums, F.lit(1), b)))

        def each(befores: Column) -> Column:
            def start(i: Column) -> Column:
                block = F.floor(i / _BLOCK).cast("int")
                return F.get(befores, block) + _sum(F.slice(lengths, block * _BLOCK + 1, i - block * _BLOCK))

            return F.transform(F.sequence(F.lit(1), n - 2, F.lit(2)), start)

        return let(blocks, lambda sums: let(before(sums), each))

    return let(F.transform(parts, F.length), of)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of ``before``, ``match``, ``start``, ``end`` (code points, end exclusive)."""
    marked = F.regexp_replace(F.translate(text, _MARK, _STAND_IN), f"({pattern})", f"{_MARK}$1{_MARK}")

    def found(parts: Column) -> Column:
        def one(start: Column, i: Column) -> Column:
            match = F.get(parts, 2 * i + 1)
            return F.struct(
                F.get(parts, 2 * i).alias("before"), match.alias("match"), start.alias("start"), (start + F.length(match)).alias("end")
            )

        return F.when(F.size(parts) > 2, F.transform(_starts(parts), one))

    return F.coalesce(let(F.split(marked, _MARK), found), F.expr("cast(array() as array<struct<before:string,match:string,start:int,end:int>>)"))


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""

    def weighed(backwards: Column) -> Column:
        def digit(i: Column) -> Column:
            return let(F.substr(backwards, i + 1, F.lit(1)).cast("int"), lambda x: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x))

        return _sum(F.transform(F.sequence(F.lit(0), F.length(backwards) - 1), digit))

    return let(F.reverse(digits), weighed) % 10 == 0


def _card(match: Column) -> Column:
    return let(F.translate(match, " -", ""), lambda d: F.length(d).between(13, 19) & luhn(d))


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
    "card": lambda m: F.when(F.length(m) >= 13, _card(m)).otherwise(False),
    "phone": lambda m: F.length(F.translate(m, "+ ().-", "")).between(9, 15),
}
#: What a text must hold for a kind to be looked for.
_NEEDS = {"email": lambda t: t.contains("@"), "ip": lambda t: t.rlike("[0-9]"), "card": lambda t: t.rlike("[0-9]"), "phone": lambda t: t.contains("+")}

_SPANS = "array<struct<kind:string,start:int,end:int>>"
_NONE = f"cast(array() as {_SPANS})"


def spans_of(text: Column, kind: str) -> Column:
    """Valid matches of one kind, in order; a failing match is dropped and not tried again."""
    valid = F.filter(matches(text, PATTERNS[kind]), lambda m: VALID[kind](m["match"]))
    spans = F.transform(valid, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    return F.when(_NEEDS[kind](text), spans).otherwise(F.expr(_NONE))


def _scan(docs: DataFrame) -> DataFrame:
    """Per document: ``key``, ``doc_id``, ``digest``, ``base`` spans and candidate tokens; no text."""
    text = F.coalesce("text", F.lit(""))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    base = named.select("doc_id", "text", F.xxhash64("text").alias("digest"), F.concat(*(spans_of(F.col("text"), k) for k in KINDS)).alias("base"))

    def pattern(ms: Column, i: Column) -> Column:
        """The two words before; where fewer are left since the token before, that token and what is before it count."""
        before = F.get(ms, i)["before"]
        lead = F.when(i < 2, f"{START} {START} ").otherwise(f"{IDENTIFIER} ")
        earlier = F.when(i == 0, "").otherwise(F.concat(F.get(ms, i - 1)["before"], F.lit(IDENTIFIER)))

        def shown(own: Column) -> Column:
            words = F.when(own != "", own).otherwise(F.regexp_extract(F.concat(lead, earlier, before), WORDS_BEFORE, 1))
            return let(F.lower(words), lambda w: F.when(F.length(w) > LONG_PATTERN, F.md5(w.cast("binary"))).otherwise(w))

        return let(F.regexp_extract(before, WORDS_BEFORE, 1), shown)

    def candidate(ms: Column, m: Column, i: Column) -> Column:
        return F.struct(
            pattern(ms, i).alias("pattern"),
            F.lower(m["match"]).alias("token"),
            m["start"].alias("start"),
            m["end"].alias("end"),
        )

    found = let(matches(F.col("text"), CANDIDATE), lambda ms: F.transform(ms, lambda m, i: candidate(ms, m, i)))
    held = F.when(F.col("text").rlike("[0-9@]"), found)
    return base.select(F.monotonically_increasing_id().alias("key"), "doc_id", "digest", "base", held.alias("held"))


def _candidates(scanned: DataFrame) -> DataFrame:
    """A row for each candidate: ``key``, ``pattern``, ``token``, ``start``, ``end`` and whether it is a ``seed``.

    A seed overlaps a base span.  The rest of an identifier (a token inside a
    span that started before it) tells nothing by itself and has no pattern.
    Both follow from the spans before and after it in one pass over the places
    of a text, so a text with many spans costs no more for each.
    """
    tokens = scanned.select("key", F.explode("held").alias("c")).select("key", "c.*", F.lit(False).alias("base"))
    spans = scanned.select("key", F.explode("base").alias("s")).select("key", "s.start", "s.end", F.lit(True).alias("base"))
    events = tokens.unionByName(spans, allowMissingColumns=True)
    earlier = Window.partitionBy("key").orderBy("start").rangeBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("key").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.coalesce(F.max(F.when(F.col("base"), F.col("end"))).over(earlier), F.lit(0))
    coming = F.min(F.when(F.col("base"), F.col("start"))).over(later)
    placed = events.select("*", reached.alias("reached"), coming.alias("coming")).where(~F.col("base"))
    inside = F.col("reached") > F.col("start")
    seed = inside | F.coalesce(F.col("coming") < F.col("end"), F.lit(False))
    return placed.select("key", F.when(inside, "").otherwise(F.col("pattern")).alias("pattern"), "token", "start", "end", seed.alias("seed"))


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Confidence of patterns from the graph ``pattern``, ``token``, ``seed``; columns ``pattern``, ``confidence``.

    A token's score is 1 for a seed and else the probability that any of its
    patterns is right; a pattern's is the mean score of its tokens, with two
    unknown tokens added.  Each round is written, so the plan stays short.
    """
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("tokens")).where(F.col("tokens") >= LEAST_INSTANCES)
    edges = materialize(edges.join(sizes, "pattern").withColumn("score", F.col("seed").cast("double")), "graph")
    patterns = edges
    for _ in range(rounds):
        patterns = edges.groupBy("pattern").agg((F.sum("score") / (F.max("tokens") + 2)).alias("confidence"))
        again = edges.join(patterns, "pattern")
        by_token = again.groupBy("token").agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("found"))
        score = F.when(F.col("seed"), 1.0).otherwise(F.col("found")).alias("score")
        edges = materialize(edges.drop("score").join(by_token, "token").select("pattern", "token", "seed", "tokens", score), "graph")
    return edges.groupBy("pattern").agg((F.sum("score") / (F.max("tokens") + 2)).alias("confidence"))


def detect(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """All spans of every text: ``doc_id``, ``digest`` (hash of the text), ``base`` and ``found`` (arrays of kind, start, end).

    ``base`` is ordered by kind, then place; ``found`` has the spans that only
    context gives, none of which overlaps one of ``base``.  A null text is
    empty and has none.  Repeated rows give repeated results (and count once
    more as evidence only if their tokens differ); a null id stays; other
    columns are ignored.
    """
    scanned = materialize(_scan(docs), "scanned")
    held = materialize(_candidates(scanned), "candidates").where("pattern <> ''")
    seed = F.col("seed") | F.col("token").rlike(KEY)
    edges = held.groupBy("pattern", "token").agg(F.max(seed).alias("seed"))
    good = score_patterns(edges, rounds).where(F.col("confidence") >= CONFIDENT).select("pattern")
    spans = held.where(~F.col("seed")).join(good, "pattern").select("key", F.struct(F.lit(CONTEXT).alias("kind"), "start", "end").alias("s"))
    by_text = spans.groupBy("key").agg(F.sort_array(F.collect_list("s")).alias("found"))  # as many as the text has tokens
    return scanned.join(by_text, "key", "left").select("doc_id", "digest", "base", F.coalesce("found", F.expr(_NONE)).alias("found"))


def shown(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts by kind and all spans as text, for every document."""
    spans = detect(docs)
    of_kind = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [of_kind(k).alias(f"n_{k}") for k in KINDS]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(shown(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        shown(F.concat("base", "found")).alias("spans"),
    )


#: Code points of the blocks that a text is cut into, so that a place in it is found at once.
_CUT = 256


def _piece(blocks: Column, start: Column, end: Column) -> Column:
    """The text from one place to another, put together from its blocks."""
    first, last = F.floor(start / _CUT).cast("int"), F.floor((end - 1) / _CUT).cast("int")
    at, rest = (start % _CUT + 1).cast("int"), ((end - 1) % _CUT + 1).cast("int")
    inside = F.substr(F.get(blocks, first), at, end - start)
    over = F.concat(
        F.substr(F.get(blocks, first), at, F.lit(_CUT)),
        F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
        F.substr(F.get(blocks, last), F.lit(1), rest),
    )
    return F.when(end <= start, "").when(first == last, inside).otherwise(over)


def redacted(text: Column, cuts: Column) -> Column:
    """The text with its cuts taken out: ``start``, ``end``, ``done`` (where the text is dealt with up to) and ``kind``, in order.

    A cut that starts where the text is dealt with already only lengthens the one before it.
    """

    def joined(blocks: Column) -> Column:
        def piece(c: Column) -> Column:
            label = F.concat(F.lit("["), F.upper(c["kind"]), F.lit("]"))
            return F.when(c["start"] >= c["done"], F.concat(_piece(blocks, c["done"], c["start"]), label)).otherwise("")

        over = F.array_max(F.transform(cuts, lambda c: c["end"]))
        return F.concat(F.array_join(F.transform(cuts, piece), ""), let(over, lambda at: _piece(blocks, at, F.length(text))))

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CUT}}}"), F.lit(0)), joined)


def _cuts(spans: DataFrame) -> DataFrame:
    """``doc_id``, ``digest`` and the ``cuts`` of each text, in order and each with where the ones before it end."""
    each = spans.select("doc_id", "digest", F.explode("spans").alias("s")).select("doc_id", "digest", "s.*")
    order = Window.partitionBy("doc_id", "digest").orderBy("start", F.desc("end"), "kind")
    done = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # as many as the text has spans; of spans that start together the longest is first, as it alone starts where nothing is done
    cut = F.struct("start", done.alias("done"), "end", "kind")
    return each.select("doc_id", "digest", cut.alias("c")).groupBy("doc_id", "digest").agg(F.sort_array(F.collect_list("c")).alias("cuts"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced; ``n_chars``, if there, follows the text.

    Spans are joined by id and hash of the text, so repeated rows and null ids
    keep their own; a text without spans is unchanged.
    """
    spans = detect(docs).where("size(base) + size(found) > 0").select("doc_id", "digest", F.concat("base", "found").alias("spans"))
    left, right = docs.alias("l"), _cuts(spans.dropDuplicates(["doc_id", "digest"])).alias("r")
    digest = F.xxhash64(F.coalesce("l.text", F.lit("")))
    joined = left.join(right, F.col("l.doc_id").cast("long").eqNullSafe(F.col("r.doc_id")) & (digest == F.col("r.digest")), "left")
    text = F.when(F.col("r.cuts").isNull(), F.col("l.text")).otherwise(redacted(F.col("l.text"), F.col("r.cuts")))
    out = joined.select(*(text.alias("text") if c == "text" else F.col(f"l.`{c}`").alias(c) for c in docs.columns))
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind))).select(*docs.columns)
