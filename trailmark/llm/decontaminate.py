"""Benchmark decontamination by template canonicalisation, with built-in functions only.

Numbers, names and units of a text become typed placeholders, so a question with other numbers or names has the
same template. Windows of template tokens are joined with the benchmark's by hash, and windows of lower-cased words
beside them, as a copy in capitals or title case is all names. For each way an item lies over a document the slots
are then checked: one value in the item must stand for one value in the document, letter case aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.llm.common import cut

NUMBER, NAME, UNIT = "#number", "#name", "#unit"

#: Words counted as units, and as numbers.
UNITS = (
    "mm cm km kilometre kilometres kilometer kilometers metre metres meter meters mile miles inch inches foot feet yard yards mg kg gram grams kilogram "
    "kilograms pound pounds ounce ounces ton tons litre litres liter liters ml gallon gallons second seconds "
    "minute minutes hour hours day days week weeks month months year years dollar dollars euro euros cent cents "
    "rupee rupees yen percent degree degrees watt watts volt volts byte bytes kb mb gb"
).split()
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million"
).split()

#: Scripts without spaces between words; each letter is a token. None lies below Thai, and a look at the range is
#: much cheaper than at the scripts.
UNSPACED = r"[\x{E00}-\x{10FFFF}&&[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]]"
LETTER = r"^\p{IsLatin}$"  # a single letter is a mark or a variable, not a word

BITMAP_WORDS = 1 << 15  # 64-bit words of the bitmap that tells most windows apart from the benchmark's


def spaced_tokens(text: Column) -> Column:
    """Runs of letters and digits, single letters in scripts without spaces, in one string; a point, comma or colon
    between digits belongs to the number."""
    held = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?<=[0-9])[.,:](?=[0-9])", "_")
    held = F.when(held.rlike(UNSPACED), F.regexp_replace(held, f"({UNSPACED})", " $1 ")).otherwise(held)
    return F.trim(F.regexp_replace(held, r"[^\p{L}\p{N}_]+", " "))


def is_number(low: Column) -> Column:
    return ((low >= "0") & (low < ":")) | low.isin(NUMBERS)  # ":" follows "9"


def folded_token(low: Column, value=lambda token: token) -> Column:
    """``value`` of the typed placeholder of a number or unit, else of the word, which is in lower case."""
    number, unit = value(F.lit(NUMBER)), value(F.lit(UNIT))
    return F.when(is_number(low), number).when(low.isin(UNITS), unit).otherwise(value(low))


def is_name(raw: Column, low: Column) -> Column:
    """A word with a capital first letter; only tokens that differ from their lower case are looked at closely."""
    first = F.substring(raw, 1, 1)
    return (raw != low) & (first != F.lower(first)) & ~is_number(low) & ~low.isin(UNITS)


def template_token(raw: Column) -> Column:
    """The typed placeholder of a number, unit or name, else the word."""
    low = F.lower(raw)
    return F.when(is_name(raw, low), NAME).otherwise(folded_token(low))


def _hash_runs(rows: DataFrame, column: str, length: int) -> DataFrame:
    """``rows`` with the token hashes in ``column`` replaced by the hash of the ``length`` tokens from each place on.

    Runs of twice the length are two runs side by side, a length between has two that overlap. The last
    ``length - 1`` places have no such run; what stands there means nothing.
    """
    others = [c for c in rows.columns if c != column]
    done = 1
    while done < length:
        ahead = min(done, length - done)
        rest = F.slice(column, F.lit(ahead + 1), F.size(column))
        rows = rows.select(*others, F.zip_with(column, rest, lambda a, b: F.xxhash64(a, b)).alias(column))
        done += ahead
    return rows


def _places(tokens: str, window: int | Column) -> Column:
    """0, 1, ... for every window of the array column, or none."""
    last = F.size(tokens) - window
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _tokens(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, raw, low): the tokens of each text as they stand and in lower case."""
    rows = df.select(F.col(f"`{id_column}`").alias("id"), spaced_tokens(F.col(f"`{text_column}`")).alias("spaced"))
    return rows.select(
        "id", *(F.filter(F.split(c, " ", -1), lambda w: w != "").alias(n) for n, c in (("raw", F.col("spaced")), ("low", F.lower("spaced"))))
    )


def _piece(tokens: str, at: Column, window: int | Column) -> Column:
    return F.slice(tokens, at + 1, window if isinstance(window, Column) else F.lit(window))


def benchmark_windows(benchmark: DataFrame, id_column: str, text_column: str, window: int, literals: int) -> DataFrame:
    """(item_id, item_at, hash, item_form, item_raw, exact) of windows with at least ``literals`` plain words.

    A window of placeholders alone says nothing about a text. Each window stands in its template form and, where
    that has names, in its case-folded form too, which a copy in capitals or title case shares. An item without
    such windows (names or capitals throughout) has those with enough words in the folded form, where a single
    letter is no word. An item without these as well (short, or of numbers) is ``exact``: all windows of its
    lower-cased tokens, a shorter item being one window. Only items of single letters have none. Repeated items
    count once.
    """
    rows = _tokens(benchmark, id_column, text_column)
    rows = rows.withColumn("folded", F.transform("low", lambda t: folded_token(t))).withColumn("template", F.transform("raw", template_token))

    def usable(tokens: str, word) -> Column:
        return F.filter(_places("template", window), lambda at: F.size(F.filter(_piece(tokens, at, window), word)) >= literals)

    rows = rows.withColumn("own", usable("template", lambda t: ~t.startswith("#")))
    rows = rows.withColumn("spare", usable("folded", lambda t: ~t.startswith("#") & ~t.rlike(LETTER)))
    says = F.exists("low", lambda t: ~t.rlike(LETTER))
    length = F.least(F.size("low"), F.lit(window))
    templates, folded = (
        rows.where(kind).select(
            F.col("id").alias("item_id"), F.lit(False).alias("exact"), "raw", "template", "folded", F.explode(places).alias("item_at")
        )
        for kind, places in ((F.size("own") > 0, "own"), ((F.size("own") == 0) & (F.size("spare") > 0), "spare"))
    )
    exact = rows.where((F.size("own") == 0) & (F.size("spare") == 0) & says).select(
        F.col("id").alias("item_id"), F.lit(True).alias("exact"), "raw", "low", length.alias("length"),
        F.explode(_places("low", length)).alias("item_at"),
    )
    at = F.col("item_at")
    kept = ["item_id", "item_at", "exact"]
    forms = (
        templates.select(
            *kept, _piece("raw", at, window).alias("item_raw"),
            F.explode(F.array_distinct(F.array(_piece("template", at, window), _piece("folded", at, window)))).alias("item_form"),
        )
        .unionByName(folded.select(*kept, _piece("raw", at, window).alias("item_raw"), _piece("folded", at, window).alias("item_form")))
        .unionByName(
            exact.select(*kept, _piece("raw", at, F.col("length")).alias("item_raw"), _piece("low", at, F.col("length")).alias("item_form"))
        )
    )
    hashed = forms.select("item_id", "item_at", F.xxhash64("item_form").alias("hash"), "item_form", "item_raw", "exact")
    return hashed.dropDuplicates(["item_id", "item_at", "hash"])


def _bitmap(windows: DataFrame, window: int) -> DataFrame:
    """One row: an array of ``BITMAP_WORDS`` longs in which every window has set the bit of its tokens' hashes.

    An exact window has any length; its hash is that of the list of token hashes, the others' that of their run.
    """
    forms = windows.select("exact", F.transform("item_form", lambda t: F.xxhash64(t)).alias("tokens"))
    whole = forms.where("exact").select(F.xxhash64("tokens").alias("hash"))
    runs = _hash_runs(forms.where(~F.col("exact")), "tokens", window).select(F.get("tokens", F.lit(0)).alias("hash"))
    slots = whole.unionByName(runs).select(F.pmod("hash", F.lit(BITMAP_WORDS * 64)).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")
    )
    zeros = windows.sparkSession.range(BITMAP_WORDS).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    whole = words.unionByName(zeros).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("bitmap"))


def matched_windows(docs: DataFrame, windows: DataFrame, id_column: str, text_column: str, window: int) -> DataFrame:
    """(doc_id, at, raw, item_id, item_at, item_raw): windows of the documents whose template or folded form is an item's.

    Each token is hashed once, in its template and its folded form, and the hashes of runs are built from those of
    shorter runs. They are looked up in the bitmap inside the row, before anything is exploded. What is left, the true
    matches and one in some hundred others, gets its forms as words, is joined by hash and compared word by word.
    """
    rows = _tokens(docs, id_column, text_column)
    rows = rows.select("*", F.transform("low", lambda t: folded_token(t, F.xxhash64)).alias("folded"))
    named = F.zip_with("raw", "low", is_name)
    rows = rows.select("*", F.zip_with(named, "folded", lambda n, h: F.when(n, F.xxhash64(F.lit(NAME))).otherwise(h)).alias("template"))
    rows = _hash_runs(_hash_runs(rows, "folded", window), "template", window)
    # The lengths of exact windows; most benchmarks have none, and then no token is hashed for them.
    lengths = windows.where("exact").agg(F.collect_set(F.size("item_form")).alias("lengths")).scalar()
    rows = rows.select("*", _bitmap(windows, window).scalar().alias("bitmap"), lengths.alias("lengths"))
    nothing = F.array().cast("array<bigint>")
    rows = rows.withColumn("words", F.when(F.size("lengths") > 0, F.transform("low", lambda t: F.xxhash64(t))).otherwise(nothing))

    def is_set(h: Column) -> Column:
        word = F.get("bitmap", F.shiftright(h, 6).bitwiseAND(F.lit(BITMAP_WORDS - 1)).cast("int"))
        return F.call_function("getbit", word, h.bitwiseAND(F.lit(63)).cast("int")) == 1

    def hit(at: Column, form: Column, n: int | Column) -> Column:
        return F.struct(at.alias("at"), form.alias("form"), _piece("raw", at, n).alias("raw"))

    def places(marks: Column, n: int | Column) -> Column:
        last = F.size("raw") - n
        return F.filter(F.transform(marks, lambda m, at: F.when(m & (at <= last), at)), lambda at: at.isNotNull())

    # The two forms of a run without names are the same and looked up once.
    marks = F.zip_with("template", "folded", lambda t, f: is_set(t) | ((t != f) & is_set(f)))
    both = F.flatten(F.transform(places(marks, window), lambda at: F.array_distinct(F.array(
        hit(at, F.transform(_piece("raw", at, window), template_token), window),
        hit(at, F.transform(_piece("low", at, window), lambda t: folded_token(t)), window),
    ))))
    listed = lambda n: F.transform(_places("words", n), lambda at: F.xxhash64(_piece("words", at, n)))
    exact = F.flatten(F.transform("lengths", lambda n: F.transform(
        places(F.transform(listed(n), is_set), n), lambda at: hit(at, _piece("low", at, n), n)
    )))
    every = F.concat(both, exact)
    found = rows.select(F.col("id").alias("doc_id"), F.explode(every).alias("w")).select("doc_id", "w.*", F.xxhash64("w.form").alias("hash"))
    same = (found["hash"] == windows["hash"]) & (found["form"] == windows["item_form"])
    return found.join(windows, same).select("doc_id", "at", "raw", "item_id", "item_at", "item_raw").distinct()


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text", window: int = 8, literals: int = 3,
    min_coverage: float = 0.5, min_run: int = 13,
) -> DataFrame:
    """(doc_id, item_id, matched_tokens, item_tokens, coverage, reworded) of each contaminated pair.

    A pair counts when its windows, over all the ways the item lies over the document and without those that touch
    an inconsistent slot of the way (unless they are word for word the item's), cover at least ``min_coverage`` of the item's tokens that lie in some usable window, or ``min_run`` tokens.
    ``reworded``: some slot holds another value than in the item, letter case aside. Slots are consistent when each value of the
    item has one value in the document (two may become the same). An item without usable windows counts where it stands
    as a whole, letter case aside. NULL and empty texts and items of single letters match nothing; rows of a repeated doc_id count as one document; NULL ids can match like others. An
    empty table on either side gives no rows. Columns other than the named ones are not read.
    """
    windows = cut(benchmark_windows(benchmark, item_column, item_text, window, literals))
    found = matched_windows(docs, windows, id_column, text_column, window)
    lying = ["doc_id", "item_id", "shift"]
    same = F.transform("raw", F.lower) == F.transform("item_raw", F.lower)
    tokens = (
        found.withColumn("shift", F.col("at") - F.col("item_at"))
        .select(*lying, "item_at", same.alias("same"), F.posexplode(F.arrays_zip("raw", "item_raw")))
        .select(*lying, "item_at", "same", (F.col("item_at") + F.col("pos")).alias("token"), F.lower("col.raw").alias("ours"), F.col("col.item_raw").alias("raw"))
    )
    slot = template_token(F.col("raw"))
    typed = tokens.withColumn("slot", F.when(slot.startswith("#"), slot)).withColumn("theirs", F.lower("raw"))
    # One value of the item's slot, one value here: the least and the greatest must agree. Where they do not, the
    # windows with the slot fall out, but for those that are word for word the item's.
    values, place = W.partitionBy(*lying, "slot", "theirs"), W.partitionBy(*lying, "item_at")
    broken = F.col("slot").isNotNull() & (F.min("ours").over(values) != F.max("ours").over(values))
    whole = typed.withColumn("broken", broken).withColumn("broken", F.max("broken").over(place) & ~F.col("same"))
    other = F.col("slot").isNotNull() & (F.col("ours") != F.col("theirs"))
    ways = whole.where(~F.col("broken")).groupBy(*lying).agg(F.max(other).alias("reworded"), F.collect_set("token").alias("held"))
    covered = ways.select("doc_id", "item_id", "reworded", F.size("held").alias("n"), F.explode("held").alias("token"))
    pairs = covered.groupBy("doc_id", "item_id").agg(
        F.countDistinct("token").alias("matched_tokens"), F.max(F.struct("n", (~F.col("reworded")).alias("same"))).alias("widest")
    )
    usable = windows.select("item_id", F.explode(F.sequence(F.col("item_at"), F.col("item_at") + F.size("item_raw") - 1)).alias("token"), "exact")
    sizes = usable.groupBy("item_id").agg(F.countDistinct("token").alias("item_tokens"), F.max("exact").alias("exact"))
    share = F.col("matched_tokens") / F.col("item_tokens")
    return (
        pairs.join(sizes, "item_id")
        .where(F.when(F.col("exact"), F.col("widest.n") == F.col("item_tokens")).otherwise((share >= min_coverage) | (F.col("matched_tokens") >= min_run)))
        .select("doc_id", "item_id", "matched_tokens", "item_tokens", F.round(share, 6).alias("coverage"), (~F.col("widest.same")).alias("reworded"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all columns; rows with a NULL id stay."""
    bad = contamination(docs, benchmark, id_column, text_column, **options).select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, F.col(f"`{id_column}`") == F.col("__bad"), "left_anti")
