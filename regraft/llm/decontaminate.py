"""Benchmark decontamination by template windows, in DataFrame operations only.

Numbers, names and units become typed placeholders; every window of ``WINDOW``
canonical words of a document is hashed and joined with the windows of the
benchmark. A hit proposes an alignment, a diagonal of document position less item
position, along which the words themselves are compared. A word agrees if it is
the same or a placeholder of the same type whose value goes where most places of
that item value go (more than half), so a question asked again with other numbers
or names is caught, also if two of them coincide, and a chance mixture is not. A
window counts if all its words agree. An item is found in a document if at least
``share`` of its distinct windows count, or of those with ``LITERALS`` words or
more that aren't placeholders; it is ``exact`` if no value differs. Windows are
joined on their plain words too, so those of fewer such words are found where a
document holds them word for word (letter case and punctuation aside). Each window of the
benchmark has an anchor, a few plain words in a row that any passage it agrees with
holds unchanged; only documents that hold some anchor are typed and hashed by
windows. A capitalised word is a name, at the beginning of a sentence if it isn't a usual one
there.

Defined results: null and empty texts have no window; an item of fewer words
than a window is one window as a whole, and is left out if it has fewer than ``shortest`` (by
default ``LITERALS``) words at all, as "yes" would be found anywhere; repeated
rows of documents give the hits of one, rows that share an id are judged each by
its text, and a null id is one like others; texts that repeat an ``item_id`` are judged one by one and the best
covered is shown; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import given_id, row_key, stage, with_key

WINDOW = 8
#: Words of a window that must not be placeholders where values may differ.
LITERALS = 5
#: Windows of a benchmark that are broadcast; beyond it the join is shuffled.
BROADCAST_WINDOWS = 1_000_000
#: Words of an anchor, the most that a window has; five words of eight that aren't placeholders hold two in a row.
ANCHORS = (4, 2, 1)

# Placeholders, spelled numbers and units.
NUMBER, UNIT, NAME = "\u0001n", "\u0001u", "\u0001p"
SPELLED = "zero|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety|hundred|thousand|million|billion|dozen"
UNITS = "mm|cm|dm|m|km|in|inch|inches|ft|foot|feet|yd|yards?|miles?|mi|mg|g|kg|t|tons?|tonnes?|lbs?|oz|pounds?|ml|cl|l|litres?|liters?|gallons?|ms|s|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|metres?|meters?|kilometres?|kilometers?|grams?|kilograms?|dollars?|cents?|euros?|percent|degrees?|hz|khz|mhz|ghz|w|kw|v|a|j|kj|n|pa|kb|mb|gb|tb|mph|kph|usd|eur|gbp"
#: Function words and other common openings of sentences and questions.
OPENERS = (
    "The|This|That|These|Those|There|Their|They|Then|Than|Though|Although|Through|Throughout|Thus|Therefore|An|And|Any|All|Also|Another|Among|About|Above|Across|After|Again|Against|Along|"
    "Already|Always|As|At|Away|Because|Before|Behind|Below|Beneath|Beside|Besides|Between|Beyond|Both|But|By|Can|Cannot|Could|Did|Do|Does|Doing|Done|Down|During|Each|Either|Else|Even|"
    "Ever|Every|Everyone|Everything|Except|Few|Finally|First|Firstly|For|From|Further|Furthermore|Given|Had|Has|Have|Having|He|Hence|Her|Here|Hers|Him|His|How|However|If|In|Indeed|"
    "Inside|Instead|Into|Is|It|Its|Just|Last|Lastly|Later|Less|Let|Like|Many|Maybe|Meanwhile|Might|More|Moreover|Most|Much|Must|My|Near|Nearly|Neither|Never|Nevertheless|Next|No|"
    "Nobody|None|Nor|Not|Nothing|Now|Of|Off|Often|On|Once|One|Only|Or|Other|Others|Otherwise|Our|Out|Outside|Over|Perhaps|Per|Please|Quite|Rather|Second|Secondly|Several|Shall|She|"
    "Should|Similarly|Since|So|Some|Someone|Something|Sometimes|Soon|Still|Such|Suppose|Assume|Sure|Together|Too|Toward|Towards|Under|Unless|Unlike|Until|Up|Upon|Us|Very|Was|We|Well|"
    "Were|What|Whatever|When|Whenever|Where|Whereas|Wherever|Whether|Which|Whichever|While|Who|Whoever|Whole|Whom|Whose|Why|With|Within|Without|Would|Yes|Yet|You|Your|Yours|To|"
    "Are|Am|Be|Been|Being|Answer|Calculate|Choose|Compute|Consider|Describe|Determine|Evaluate|Explain|Express|Find|Give|Identify|List|Note|Prove|Question|Select|Show|Simplify|Solve|"
    "State|Use|Using|Write|Read|True|False"
)
PUNCTUATION = ".,;:!?\"'()[]{}<>«»“”„‘’…"

_EDGE_BEFORE, _EDGE_AFTER = r"(?<![^ ])", r"(?![^ ])"
_CLOSE = r"[.,;:!?)\]\"']*"
_NUMBERS = rf"{_EDGE_BEFORE}[(\[\"'$€£]*[+-]?(?:[0-9][0-9.,:/]*(?:%|st|nd|rd|th|(?i:{UNITS}))?|(?i:{SPELLED})){_CLOSE}{_EDGE_AFTER}"
_UNITS_AFTER = rf"(?<=\u0001n )(?i:{UNITS}){_CLOSE}{_EDGE_AFTER}"
# a capitalised word within a sentence, or at its beginning if it is none of OPENERS; what else the text holds has no say, as equal windows have to be typed alike
_OPEN = "[(\\[\"'“‘«„]*"
_NAMES = rf"{_EDGE_BEFORE}(?={_OPEN}\p{{Lu}}\p{{Ll}})(?:(?<=[\p{{L}}\p{{N}},;:] )|{_OPEN}(?!(?:{OPENERS}){_CLOSE}{_EDGE_AFTER}))\p{{Lu}}\p{{Ll}}+{_CLOSE}{_EDGE_AFTER}"


def _spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))


def _canonical(spaced: Column) -> Column:
    """As many words as ``spaced``, some of them empty."""
    typed = F.regexp_replace(F.translate(spaced, "\u0001", ""), _NUMBERS, NUMBER)
    typed = F.regexp_replace(F.regexp_replace(typed, _UNITS_AFTER, UNIT), _NAMES, NAME)
    return F.translate(F.lower(typed), PUNCTUATION, "")


def _typed_words(text: Column) -> Column:
    return F.array_remove(F.split(_canonical(_spaced(text)), " "), "")


def _plain_words(text: Column) -> Column:
    """The words that typed ones stand for, lower case without punctuation, as many as those."""
    plain = F.when(F.contains(text, F.lit("\u0001")), F.translate(text, "\u0001", "")).otherwise(text)
    return F.array_remove(F.split(F.translate(F.lower(plain), PUNCTUATION, ""), r"[\x20\x09-\x0D]+"), "")


def _with_windows(words: DataFrame, lengths: list[int]) -> DataFrame:
    """The columns ``typed`` and ``plain`` hashed, and ``windows``: of each window its length, first word and both hashes.

    Each word is hashed once; hashes of twice as many words come from two of half
    as many, those of other lengths from two that overlap.
    """
    hashed = words.withColumns({c: F.transform(c, lambda w: F.xxhash64(w)) for c in ("typed", "plain")})

    def pairs(column: str, apart: int) -> Column:
        return F.transform(column, lambda h, i: F.xxhash64(h, F.get(F.col(column), i + apart)))

    size = 1
    while 2 * size <= max(lengths):
        hashed = hashed.withColumns({f"{c}{2 * size}": pairs(c if size == 1 else f"{c}{size}", size) for c in ("typed", "plain")})
        size *= 2
    for n in lengths:
        half = 1 << (n.bit_length() - 1)
        if n != half:
            hashed = hashed.withColumns({f"{c}{n}": pairs(c if half == 1 else f"{c}{half}", n - half) for c in ("typed", "plain")})
    parts = []
    for n in lengths:
        typed, plain = ("typed", "plain") if n == 1 else (f"typed{n}", f"plain{n}")
        # zipped rather than looked up, as a lookup in a function could be planned as its whole array for each word
        each = F.transform(F.arrays_zip(F.col(typed), F.col(plain)), lambda h, i: F.struct(
            F.lit(n).alias("length"), i.alias("place"), h[typed].alias("typed"), h[plain].alias("plain")))  # noqa: B023
        parts.append(F.slice(each, 1, F.greatest(F.size("plain") - (n - 1), F.lit(0))))
    return hashed.withColumn("windows", F.concat(*parts) if len(parts) > 1 else parts[0])


def benchmark_items(benchmark: DataFrame, shortest: int = LITERALS) -> DataFrame:
    """``item_id, item, typed, plain, length``: each distinct text of an id that has ``shortest`` words or more."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        "item_id", F.xxhash64("text").alias("item"), _typed_words(F.col("text")).alias("typed"), _plain_words(F.col("text")).alias("plain")
    ).distinct()
    return items.withColumn("length", F.least(F.size("typed"), F.lit(WINDOW))).where(F.col("length") >= max(shortest, 1))


def benchmark_windows(items: DataFrame, lengths: list[int]) -> DataFrame:
    """``item_id, item, length, at, typed, plain, literal``: each distinct window of an item once, at its first place."""
    named = items.select("item_id", "item", "length", F.col("typed").alias("words"), "typed", "plain")
    each = _with_windows(named, lengths or [WINDOW]).select("item_id", "item", "length", "words", F.explode_outer("windows").alias("hashes"))
    each = each.where("length = hashes.length").withColumn("at", F.col("hashes.place"))
    slots = F.size(F.filter(F.slice("words", F.col("at") + 1, F.col("length")), lambda w: w.startswith("\u0001")))
    each = each.select("item_id", "item", "length", "at", "hashes.typed", "hashes.plain", (F.col("length") - slots >= LITERALS).alias("literal"))
    return (
        each.groupBy("item_id", "item", "length", "plain").agg(F.min(F.struct("at", "typed", "literal")).alias("first"))
        .select("item_id", "item", "length", "first.at", "first.typed", "plain", "first.literal")
    )


def window_keys(known: DataFrame) -> DataFrame:
    """``item_id, item, length, at, hash``: plain words of every window, and typed ones of those with enough literals."""
    rows = known.select("item_id", "item", "length", "at", F.explode(F.when(
        F.col("literal"), F.array_distinct(F.array("plain", "typed"))).otherwise(F.array("plain"))).alias("hash"))
    return rows.groupBy("item_id", "item", "length", "hash").agg(F.min("at").alias("at"))


def _with_runs(words: DataFrame, longest: int) -> DataFrame:
    """``run1``, ``run2`` ... up to ``longest``: a hash for each run of so many plain words; the last ones end early."""
    hashed, size = words.withColumn("run1", F.transform("plain", lambda w: F.xxhash64(w))), 1
    while size < longest:
        column = f"run{size}"
        hashed = hashed.withColumn(f"run{2 * size}", F.transform(column, lambda h, i: F.xxhash64(h, F.get(F.col(column), i + size))))  # noqa: B023
        size *= 2
    return hashed


def window_anchors(known: DataFrame, items: DataFrame) -> DataFrame:
    """``size, run``: for each window the longest run of words that is held unchanged wherever the window is found.

    Where values may differ that is a run without placeholders, else any.
    """
    words = _with_runs(items.select("item_id", "item", F.col("typed").alias("type"), "plain"), max(ANCHORS)).withColumnRenamed("plain", "word")
    each = known.select("item_id", "item", "length", "at", "literal").join(words, ["item_id", "item"])

    def runs(size: int) -> Column:
        first = F.when(F.col("length") >= size, F.sequence(F.lit(0), F.col("length") - size)).otherwise(F.array().cast("array<int>"))
        own = lambda column, i: F.slice(column, F.col("at") + i + 1, size)
        fixed = F.filter(first, lambda i: ~F.col("literal") | ~F.exists(own("type", i), lambda w: w.startswith("\u0001")))
        return F.transform(fixed, lambda i: F.struct(
            F.lit(size).alias("size"), F.length(F.concat_ws("", own("word", i))).alias("chars"), F.get(f"run{size}", F.col("at") + i).alias("run")))

    best = F.array_max(F.concat(*(runs(size) for size in ANCHORS)))
    return each.select(best.alias("best")).select("best.size", "best.run").distinct()


def with_anchors(texts: DataFrame, anchors: DataFrame) -> DataFrame:
    """``doc, mark`` of the texts that hold an anchor."""
    sizes = sorted(r.size for r in anchors.select("size").distinct().collect())  # of ANCHORS
    small = anchors.count() <= BROADCAST_WINDOWS
    runs = _with_runs(texts.select("doc", "mark", _plain_words(F.col("text")).alias("plain")), max(sizes, default=1))
    each = runs.select("doc", "mark", F.explode(F.concat(*(f"run{n}" for n in sizes or [1]))).alias("run"))
    known = anchors.select("run").distinct()
    return each.join(F.broadcast(known) if small else known, "run", "left_semi").select("doc", "mark").distinct()


def contamination(documents: DataFrame, benchmark: DataFrame, share: float = 0.5, shortest: int = LITERALS) -> DataFrame:
    """``doc_id, item_id, n_windows, item_windows, coverage, kind`` for each item found in a document."""
    found = found_items(documents, benchmark, share, shortest)
    return found.select(given_id("doc", "mark").alias("doc_id"), *(c for c in found.columns if c not in ("doc", "mark")))


def found_items(documents: DataFrame, benchmark: DataFrame, share: float = 0.5, shortest: int = LITERALS) -> DataFrame:
    """As :func:`contamination`, with the key of the row (``doc, mark``) in place of its id."""
    items = stage(benchmark_items(benchmark, shortest), "items")
    lengths = sorted(r.length for r in items.select("length").distinct().collect())  # WINDOW values at most
    known = stage(benchmark_windows(items, lengths), "windows")
    small = known.count() <= BROADCAST_WINDOWS
    sent = F.broadcast if small else lambda frame: frame
    doc, mark = row_key()
    texts = documents.where("text IS NOT NULL").select(doc.alias("doc"), mark.alias("mark"), "text")
    some = stage(with_anchors(texts, stage(window_anchors(known, items), "anchors")), "anchored")
    if some.count() <= BROADCAST_WINDOWS:  # of more, all are typed, which shuffles no text
        texts = texts.join(F.broadcast(some), ["doc", "mark"], "left_semi")
    words = texts.select("doc", "mark", _typed_words(F.col("text")).alias("typed"), _plain_words(F.col("text")).alias("plain"))
    # outer, as else a filter on the size of the windows would compute them a second time
    each = _with_windows(words, lengths or [WINDOW]).select("doc", "mark", F.explode_outer("windows").alias("w"))
    keys = F.when(F.col("w.plain") == F.col("w.typed"), F.array("w.plain")).otherwise(F.array("w.plain", "w.typed"))
    each = each.select("doc", "mark", F.col("w.place").alias("place"), F.col("w.length").alias("length"), F.explode(keys).alias("hash"))
    hits = each.join(sent(stage(window_keys(known), "keys")), ["hash", "length"])
    alignment = ["doc", "mark", "item_id", "item", "diagonal"]
    alignments = stage(hits.select("doc", "mark", "item_id", "item", (F.col("place") - F.col("at")).alias("diagonal")).distinct(), "alignments")

    # word by word along the diagonals, for the few documents that have some
    ids = stage(alignments.select("doc", "mark").distinct(), "ids")
    if ids.count() <= BROADCAST_WINDOWS:
        ids = F.broadcast(ids)
    ours = texts.join(ids, ["doc", "mark"], "left_semi").dropDuplicates(["doc", "mark"]).select(
        "doc", "mark", _typed_words(F.col("text")).alias("our_typed"), _plain_words(F.col("text")).alias("our_plain")
    )
    compared = alignments.join(ours, ["doc", "mark"]).join(sent(items), ["item_id", "item"]).select(
        *alignment, "length", F.posexplode(F.transform("typed", lambda t, k: F.struct(
            t.alias("type"), F.get("plain", k).alias("theirs"), F.get("our_plain", k + F.col("diagonal")).alias("ours"),
            F.get("our_typed", k + F.col("diagonal")).alias("our_type"),
        ))).alias("at", "word"),
    ).select(
        *alignment, "length", "at", "word.type", "word.theirs", "word.ours",
        F.col("word.theirs").eqNullSafe(F.col("word.ours")).alias("same"),
        (F.startswith("word.type", F.lit("\u0001")) & F.col("word.type").eqNullSafe(F.col("word.our_type"))).alias("slot"),
    )
    value = [*alignment, "type", "theirs"]
    agreeing, places = (F.count_if("slot").over(Window.partitionBy(*keys)) for keys in ([*value, "ours"], value))
    judged = compared.withColumn("agrees", F.col("same") | (F.col("slot") & (2 * agreeing > places)))
    # a text shorter than a window ends within its only one
    frame = Window.partitionBy(*alignment).orderBy("at").rowsBetween(0, WINDOW - 1)
    counting = judged.withColumn("agree", F.count_if("agrees").over(frame)).withColumn("alike", F.count_if("same").over(frame)).where(
        "agree = length"
    ).select("doc", "mark", "item_id", "item", "at", (F.col("alike") < F.col("length")).alias("changed"))
    per_window = counting.join(sent(known.select("item_id", "item", "at", "literal")), ["item_id", "item", "at"]).where(
        "literal OR NOT changed"
    ).groupBy("doc", "mark", "item_id", "item", "at", "literal").agg(F.min("changed").alias("changed"))
    totals = known.groupBy("item_id", "item").agg(F.count("*").alias("item_windows"), F.count_if("literal").alias("item_literal"))
    measure = lambda n, of: F.struct((F.col(n) / F.col(of)).alias("coverage"), F.col(n).alias("n_windows"), F.col(of).alias("item_windows"), "changed")
    return (
        per_window.groupBy("doc", "mark", "item_id", "item")
        .agg(F.count("*").alias("n_windows"), F.count_if("literal").alias("n_literal"), F.max("changed").alias("changed"))
        .join(sent(totals), ["item_id", "item"])
        .withColumn("best", F.greatest(measure("n_windows", "item_windows"), F.when(F.col("item_literal") > 0, measure("n_literal", "item_literal"))))
        .groupBy("doc", "mark", "item_id").agg(F.max("best").alias("best"))
        .where(F.col("best.coverage") >= share)
        .select(
            "doc", "mark", "item_id", "best.n_windows", "best.item_windows", "best.coverage",
            F.when(F.col("best.changed"), "reparameterised").otherwise("exact").alias("kind"),
        )
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame, share: float = 0.5, shortest: int = LITERALS) -> DataFrame:
    """The documents in which no item is found, with all their columns; texts are shuffled only if very many go."""
    found = stage(found_items(documents, benchmark, share, shortest).selectExpr("doc AS _key_id", "mark AS _key_mark").distinct(), "contaminated")
    rows = F.broadcast(found) if found.count() <= BROADCAST_WINDOWS else found
    return with_key(documents).join(rows, ["_key_id", "_key_mark"], "left_anti").select(*documents.columns)
