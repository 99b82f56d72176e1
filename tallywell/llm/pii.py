"""Personal data: fixed patterns, and identifiers found by the contexts the fixed ones stand in.

All work is in DataFrame expressions. Matches of the fixed patterns are seeds. The
ordinary word before a seed, the two before it and the one behind it are lexical
patterns once enough different seeds stand there. Patterns and the identifiers there
(words with a digit and the groups of digits that go on from them) form a graph that is
scored in turns: a pattern by the share of believed identifiers among everything in its
place, an identifier by the patterns it stands at, leaving out those that are scored.
Identifiers of high-confidence patterns become spans of the kind ``context``.

Not sought: identifiers without a digit, and contexts that hold a digit themselves or
other matches. Work in one text grows with its length times the logarithm of its matches.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import id_and_text, materialize

#: Fixed patterns of the contract, with possessive loops and a look-behind where a
#: match can only begin at the start of a run; both keep the matches and make long runs linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
KINDS = (*PATTERNS, "context")

BLANK = r" \t\n\x0B\f\r"
BLANKS = rf"[{BLANK}]+"

#: Words with a digit or a covered match, and the upper-case groups with a digit that go on from them.
EVENT = (
    rf"(?<![^{BLANK}])[^{BLANK}0-9\x02]*+[0-9\x02][^{BLANK}]*+"
    rf"(?:(?<=[0-9A-Z]) (?=[A-Z]*[0-9])[0-9A-Z]{{1,6}}(?![^{BLANK}.,;:!?)]))*+"
)
PUNCTUATION = ".,;:!?()[]{}<>\"'"

#: Code points of the pieces by which places in a text are looked up.
PIECE = 256

LEAST_SEEDS = 3
LEAST_CONFIDENCE = 0.8
ROUNDS = 3

_MARK = "\x01"
_COVER = "\x02"
_SPAN = "struct<start:int,kind:int,end:int,said:string>"
_EVENT = "struct<start:int,end:int,said:string,contexts:array<string>,known:boolean>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often ``body`` or lambdas in it use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running combination (sum, greatest) of an array of integers >= 0, by doubling steps: n log n."""
    steps = F.filter(F.array(*(F.lit(1 << k) for k in range(31))), lambda d: d < F.size(values))

    def double(done: Column, d: Column) -> Column:
        return F.transform(done, lambda x, i: combine(x, F.coalesce(F.get(done, i - d), F.lit(0))))

    return F.aggregate(steps, values, double)


def _parts(text: Column, pattern: str) -> Column:
    """The text cut at its matches; every second part is a match.

    Matches are framed by a mark, which the text itself must not hold.
    """
    return F.split(F.regexp_replace(text, F.lit(f"({pattern})"), F.lit(f"{_MARK}$1{_MARK}")), F.lit(_MARK), F.lit(-1))


def _spans_of(parts: Column, kind: int) -> Column:
    """Array of (start, kind, end, matched text) in code points, in order, of the matches among parts."""
    ends = _running(F.transform(parts, lambda p: F.length(p)), lambda a, b: a + b)

    def span(part: Column, end: Column) -> Column:
        return F.struct((end - F.length(part)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), part.alias("said")).cast(_SPAN)

    return F.filter(F.zip_with(parts, ends, span), lambda s, i: i % 2 == 1)


def _matches(text: Column, pattern: str, kind: int) -> Column:
    return _let(_parts(text, pattern), lambda parts: _spans_of(parts, kind))


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _at(pieces: Column, start: Column, size: Column) -> Column:
    """``size`` code points from ``start`` on, read from the pieces around them only."""
    first = F.floor(start / PIECE).cast("int")
    near = F.slice(pieces, first + 1, F.floor(size / PIECE).cast("int") + 2)
    return F.when(size > 0, F.substring(F.array_join(near, ""), start - first * PIECE + 1, size)).otherwise("")


def _rebuilt(text: Column, spans: Column, instead: Callable[[Column, Column], Column]) -> Column:
    """The text with ``instead(span, upto)`` for sorted spans, which may overlap; ``upto`` is where those before end."""

    def build(pieces: Column, given: Column, ends: Column) -> Column:
        def part(span: Column, i: Column) -> Column:
            upto = F.coalesce(F.get(ends, i - 1), F.lit(0))
            return F.concat(_at(pieces, upto, span["start"] - upto), instead(span, upto))

        last = F.get(ends, F.size(ends) - 1)
        return F.array_join(F.concat(F.transform(given, part), F.array(_at(pieces, last, F.length(text) - last))), "")

    def ends(given: Column) -> Column:
        return _running(F.transform(given, lambda s: s["end"]), lambda a, b: F.greatest(a, b))

    built = _let(_pieces(text), lambda p: _let(spans, lambda g: _let(ends(g), lambda e: build(p, g, e))))
    return F.when(F.size(spans) > 0, built).otherwise(text)


def _digits(said: Column) -> Column:
    return F.regexp_replace(said, "[^0-9]", "")


def _valid(kind: str, said: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return said.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.length(_digits(said)).between(12, 19) & F.call_function("luhn_check", _digits(said))
    if kind == "phone":
        return F.length(_digits(said)).between(9, 15)
    return F.lit(True)


def _valid_spans(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["said"]))


def _of_kind(spans: str, kind: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def base_spans(text: Column, digit: Column) -> Column:
    """Valid matches of all fixed patterns, by start, then kind; ``digit`` says whether the text has any."""
    needs = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    none = F.array().cast(f"array<{_SPAN}>")
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        spans = _valid_spans(_matches(text, pattern, k), kind)
        found.append(F.when(needs.get(kind, digit), spans).otherwise(none))
    return F.array_sort(F.concat(*found))


def _contexts(before: Column, behind: Column) -> Column:
    """The last word of those before, the last two, and, after a blank, the first of those behind."""
    last = F.try_element_at(before, F.lit(-1))
    two = F.when(F.size(before) > 1, F.concat_ws(" ", F.try_element_at(before, F.lit(-2)), last))
    return F.filter(F.array(last, two, F.concat(F.lit(" "), F.try_element_at(behind, F.lit(1)))), lambda c: c.isNotNull())


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), BLANKS), "")


def _events(text: Column, spans: Column) -> Column:
    """Array of (start, end, said, contexts, known) of words that hold seeds and of other identifiers.

    Seeds are covered in the text first, so a word is known where it holds a cover. Contexts
    are taken from the ordinary words between one event and the next.
    """
    length = lambda s, upto: F.greatest(s["end"] - F.greatest(s["start"], upto), F.lit(0))
    covered = _rebuilt(text, spans, lambda s, upto: F.repeat(F.lit(_COVER), length(s, upto)))

    def told(parts: Column, pieces: Column, between: Column) -> Column:
        def event(s: Column, i: Column) -> Column:
            said = F.btrim(_at(pieces, s["start"], s["end"] - s["start"]), F.lit(PUNCTUATION))
            return F.struct(
                s["start"].alias("start"), s["end"].alias("end"), said.alias("said"),
                _contexts(F.get(between, i), F.get(between, i + 1)).alias("contexts"), F.contains(s["said"], F.lit(_COVER)).alias("known"),
            )

        return F.transform(_spans_of(parts, len(PATTERNS)), event)

    def with_words(parts: Column) -> Column:
        between = F.transform(F.filter(parts, lambda p, i: i % 2 == 0), lambda p: _words(p))
        return _let(_pieces(text), lambda pieces: _let(between, lambda words: told(parts, pieces, words)))

    return _let(_parts(covered, EVENT), with_words)


def find_spans(docs: DataFrame) -> DataFrame:
    """Add to rows with ``text`` a key, ``spans`` and ``others``: (start, end, said, contexts, known) of seeds and other identifiers."""
    clean = F.translate("text", _MARK + _COVER, "\x03\x03")
    rows = docs.withColumn("key", F.monotonically_increasing_id()).withColumn("_clean", clean).withColumn("_digit", F.col("_clean").rlike("[0-9]"))
    rows = rows.withColumn("spans", base_spans(F.col("_clean"), F.col("_digit")))
    some = F.col("_digit") | (F.size("spans") > 0)
    events = F.when(some, _events(F.col("_clean"), F.col("spans"))).otherwise(F.array().cast(f"array<{_EVENT}>"))
    return rows.withColumn("others", events).drop("_clean", "_digit")


def _edges(found: DataFrame) -> DataFrame:
    """``pattern, said, known, times`` of everything identifier-like."""
    each = found.select(F.explode("others").alias("o")).select("o.said", "o.known", F.explode("o.contexts").alias("pattern"))
    return each.groupBy("pattern", "said").agg(F.max("known").alias("known"), F.count("*").alias("times"))


def _followed(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """How often each pattern stands anywhere in the texts with a word in its place."""
    rows = texts.select(_words(F.col("text")).alias("w")).where(F.size("w") > 1)
    ones = F.slice("w", 1, F.size("w") - 1)
    twos = F.zip_with(F.slice("w", 1, F.size("w") - 2), F.slice("w", 2, F.size("w") - 2), lambda a, b: F.concat_ws(" ", a, b))
    twos = F.when(F.size("w") > 2, twos).otherwise(F.array().cast("array<string>"))
    behind = F.transform(F.slice("w", 2, F.size("w") - 1), lambda w: F.concat(F.lit(" "), w))
    each = rows.select(F.explode(F.concat(ones, twos, behind)).alias("pattern"))
    return each.join(patterns.select("pattern"), "pattern", "left_semi").groupBy("pattern").agg(F.count("*").alias("followed"))


def _believed_elsewhere(unseen: DataFrame, patterns: DataFrame) -> DataFrame:
    """``said, family, elsewhere``: the belief in unseen identifiers by the patterns of all other families.

    The patterns that end with one word are a family, as they stand at the same places;
    the strongest speaks for it.
    """
    doubt = F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))
    by_family = unseen.join(patterns, "pattern").groupBy("said", "family").agg(F.min(doubt).alias("doubt"))
    total = by_family.groupBy("said").agg(F.sum("doubt").alias("total"))
    return by_family.join(total, "said").select("said", "family", (1 - F.exp(F.col("total") - F.col("doubt"))).alias("elsewhere"))


def discover(found: DataFrame, texts: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """High-confidence patterns with ``confidence``, from written spans and the texts.

    A pattern needs ``LEAST_SEEDS`` different seeds, so copies of a document lend it nothing.
    Its confidence is the sum of its identifiers' beliefs over all that stands in its
    place, ordinary words included. Seeds have belief 1; an unseen identifier has what
    patterns at its other places and on its other side say together, so no pattern
    lends belief to itself.
    """
    edges = materialize(_edges(found), "edges")
    able = edges.where("known").groupBy("pattern").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= LEAST_SEEDS)
    able = materialize(able.select("pattern"), "able")
    family = F.when(F.col("pattern").startswith(" "), F.col("pattern")).otherwise(F.substring_index("pattern", " ", -1))
    graph = materialize(edges.join(able, "pattern").withColumn("family", family), "graph")
    own = graph.groupBy("pattern").agg(F.count("*").alias("different"), F.sum("times").alias("times"))
    size = own.join(_followed(texts, able), "pattern", "left")
    ordinary = F.greatest(F.coalesce("followed", F.lit(0)) - F.col("times"), F.lit(0))
    size = materialize(size.select("pattern", (F.col("different") + ordinary).alias("size")), "sizes")

    scored = graph.withColumn("elsewhere", F.lit(0.0))
    for _ in range(rounds):
        belief = F.when(F.col("known"), F.lit(1.0)).otherwise(F.coalesce("elsewhere", F.lit(0.0)))
        total = scored.groupBy("pattern").agg(F.sum(belief).alias("total"))
        share = F.round(F.col("total") / F.col("size"), 9)
        patterns = materialize(total.join(size, "pattern").select("pattern", share.alias("confidence")), "patterns")
        scored = graph.join(_believed_elsewhere(graph.where("not known"), patterns), ["said", "family"], "left")
    return patterns.where(F.col("confidence") >= LEAST_CONFIDENCE)


def add_context_spans(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """Add ``all_spans``: the base spans and identifiers behind a high-confidence pattern."""
    each = found.select("key", F.explode(F.filter("others", lambda o: ~o["known"])).alias("o"))
    each = each.select("key", "o.start", "o.end", "o.said", F.explode("o.contexts").alias("pattern"))
    told = each.join(patterns, "pattern", "left_semi")
    span = F.struct("start", F.lit(len(PATTERNS)).alias("kind"), "end", "said").cast(_SPAN)
    # written first, so that the optimizer knows how few they are before it moves the texts
    told = materialize(told.groupBy("key").agg(F.collect_set(span).alias("more")), "context_spans")
    joined = found.join(told, "key", "left")
    return joined.withColumn("all_spans", F.array_sort(F.concat("spans", F.coalesce("more", F.array().cast(f"array<{_SPAN}>"))))).drop("more")


def _told(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, key, spans, all_spans`` of every row; ``spans`` holds the fixed kinds alone.

    Null and empty texts have no spans; repeated rows have the same ones. Spans and
    identifiers (no texts) are written once, with a key per row, as ids may repeat.
    """
    texts = id_and_text(docs, id_col, text_col)
    found = materialize(find_spans(texts).drop("text"), "spans")
    patterns = discover(found, texts)
    return add_context_spans(found, patterns).select("doc_id", "key", "spans", "all_spans")


def digests(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""
    counts = [F.size(_of_kind("spans", k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(PATTERNS)]
    return found.select("doc_id", *counts, F.sha2(_told("spans"), 256).alias("base_sha256"), _told("all_spans").alias("spans"))


def mask(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    return _rebuilt(text, spans, lambda s, upto: F.when(s["start"] < upto, F.lit("")).otherwise(F.get(names, s["kind"])))


def mask_documents(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` with personal data masked in the text, and its length where there is such a column.

    Null texts stay null. All columns stay, whatever their names.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    found = materialize(find_spans(rows), "masked")
    patterns = discover(found.drop("row", "text"), rows.select("text"))
    masked = add_context_spans(found, patterns).withColumn("_masked", mask(F.col("text"), F.col("all_spans")))
    old = F.col("row").getField(text_col)
    columns = []
    for name in docs.columns:
        value = F.col("row").getField(name)
        if name == text_col:
            value = F.when(old.isNotNull(), F.col("_masked"))
        elif name == length_col:
            value = F.when(old.isNotNull(), F.length("_masked").cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return masked.select(*columns)
