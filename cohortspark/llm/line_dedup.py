"""Line dedup: find runs of lines that occurred before by winnowing, and delete the later ones.

Lines are compared by their words; lines without a word don't count. A window is a run of words: either the shortest
run of whole lines from a line onward, or up to a line, that holds ``least_words`` words, or exactly ``least_words``
words around a whole line, which begin and end in other lines. The fingerprint of a window is its line with the least hash, of
those that no end of the window can cut. Two places that share a window share its fingerprint.

Fingerprints that occur at two places or more are joined by hash. Around each, the match is extended both ways: the
windows of whole lines go forward and backward line by line, the others word by word into the partly equal lines at both ends.
Windows that occurred earlier are repeats. Every word of a repeated run within reach of a window lies in one,
so their union is the run. A word goes if it lies in a repeated window; the first place of a passage
always stays, as nothing precedes it. The order is that of document number, then place in the text.
A passage without a whole line between two line breaks, and under ``least_words`` words of whole lines, has no fingerprint and stays;
so do words of a partly equal line that lie further than ``least_words`` from its end. Everything here is DataFrame expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import written

#: A repeated run goes if it has as many words.
LEAST_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"
#: A word with the blanks before it.
PIECE = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
#: A line break with the blanks and breaks after it.
BREAK = r"\n[\x20\x09-\x0D]*+"
#: What lies between words of a line where it is not a single space.
GAP = r"[\x20\x09\x0B-\x0D]{2,}+|[\x09\x0B-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
KEY = ["_id", "_text"]


def _pieces(text) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE), 0)


def _odd(text: str) -> Column:
    """Whether a text has blanks other than single spaces and line breaks."""
    has = [F.contains(F.col(text), F.lit(x)) for x in ("  ", "\t", "\r", "\x0b", "\x0c")]
    return reduce(lambda a, b: a | b, has)


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _window_key(first: Column, others: Column) -> list[Column]:
    """``key`` and ``check``: 128 bits of a window's first hash and the array of the others, as two folds in different order."""
    return [F.xxhash64(first, others).alias("key"), F.xxhash64(others, first).alias("check")]


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """The other columns of a row, its text, and a key of its own: document number and a hash of the text, as numbers may be null or repeat."""
    told, others = F.col(text), [c for c in docs.columns if c != text]
    return docs.select(F.struct(*others).alias("row"), told.alias("text"), F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(told, F.lit(""))).alias("_text"))


def text_lines(keyed: DataFrame, least_words: int) -> DataFrame:
    """Lines with a word: number of words, words of the text before (``since``) and with it (``until``), hash.

    ``lowest`` and ``highest`` bound the starts of the windows of ``least_words`` words whose fingerprint the line is: they have a word
    at least of the line before and of the line after (``around`` is a hash of the line and these two words), and no other whole line between two breaks has a lesser hash (the first of equal ones counts).
    Rows that are wholly equal give their lines once.
    """
    split = keyed.select(*KEY, F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    # Words stay text, one space between two: no arrays of words. Patterns only where a look for odd blanks finds some.
    one = F.regexp_replace(F.btrim("line", F.lit(BLANKS)), GAP, " ")
    split = split.select(*KEY, "pos", F.when(_odd("line"), one).otherwise(F.trim("line")).alias("line")).filter("line != ''")
    words = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    split = split.select(*KEY, "pos", words.cast("long").alias("words"), _digest(F.col("line")).alias("hash"),
                         F.hash(F.substring_index("line", " ", 1)).alias("opens"), F.hash(F.substring_index("line", " ", -1)).alias("closes"))
    lines = split.repartition(*KEY).dropDuplicates([*KEY, "pos"])
    by_doc = W.partitionBy(*KEY)
    until = F.sum("words").over(by_doc.orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    lines = lines.withColumns({"until": until, "total": F.sum("words").over(by_doc)}).withColumn("since", F.col("until") - F.col("words"))
    before = F.collect_list(F.struct("hash", "since")).over(by_doc.orderBy("since").rangeBetween(-least_words, -1))
    after = F.collect_list(F.struct("hash", "until")).over(by_doc.orderBy("until").rangeBetween(1, least_words))
    around = F.xxhash64("hash", F.lag("closes").over(by_doc.orderBy("pos")), F.lead("opens").over(by_doc.orderBy("pos")))
    lines = lines.withColumns({"before": before, "after": after, "around": around})
    left = F.array_max(F.transform(F.filter("before", lambda x: x["hash"] <= F.col("hash")), lambda x: x["since"]))
    right = F.array_min(F.transform(F.filter("after", lambda x: x["hash"] < F.col("hash")), lambda x: x["until"]))
    lowest = F.greatest(F.col("until") + (1 - least_words), left, F.lit(0).cast("long"))
    highest = F.least(F.col("since") - 1, F.col("total") - least_words, right - least_words)
    return lines.select(*KEY, "words", "since", "until", "hash", "around", lowest.alias("lowest"), highest.alias("highest"))


def line_windows(lines: DataFrame, least_words: int) -> DataFrame:
    """A row for each fingerprint place: ``mark`` (the least line hash), and the windows of whole lines it stands for."""
    by_doc = W.partitionBy(*KEY)
    onward = by_doc.orderBy("since").rangeBetween(0, least_words - 1)
    back = by_doc.orderBy("until").rangeBetween(-(least_words - 1), 0)

    def over(frame) -> Column:
        hashes = F.collect_list("hash").over(frame)
        return F.struct(
            F.min("since").over(frame).alias("start"), (F.max("until").over(frame) - 1).alias("end"), F.sum("words").over(frame).alias("words"),
            F.min(F.struct("hash", (-F.col("since")).alias("at"))).over(frame).alias("least"),
            *_window_key(F.lit("lines"), hashes))

    both = lines.select(*KEY, over(onward).alias("onward"), over(back).alias("back"))
    both = both.select(*KEY, F.explode(F.array("onward", "back")).alias("w")).filter(F.col("w.words") >= least_words)
    grouped = both.groupBy(*KEY, F.col("w.least.at").alias("at"), F.col("w.least.hash").alias("mark"))
    return grouped.agg(F.collect_set(F.struct("w.start", "w.end", "w.key", "w.check")).alias("windows"))


def _twice(places: DataFrame, mark: str, place: Column) -> DataFrame:
    """Values of ``mark`` at two places or more."""
    return places.groupBy(mark).agg(F.min(place).alias("a"), F.max(place).alias("z")).filter("a != z").select(mark)


def near_lines(fingerprints: DataFrame) -> DataFrame:
    """Windows of whole lines around fingerprints that occur twice: ``start``, ``end`` (places of the first and last word), ``key``, ``check``."""
    near = fingerprints.join(_twice(fingerprints, "mark", F.struct(*KEY, "at")), "mark", "left_semi")
    return near.select(*KEY, F.explode("windows").alias("w")).select(*KEY, "w.*")


def near_words(keyed: DataFrame, lines: DataFrame, least_words: int) -> DataFrame:
    """Windows of ``least_words`` words around fingerprints that occur twice, as :func:`near_lines`."""
    prints = lines.filter("lowest <= highest")
    found = prints.join(_twice(prints, "around", F.struct(*KEY, "since")), "around", "left_semi")
    found = found.groupBy(*KEY).agg(F.flatten(F.collect_list(F.sequence("lowest", "highest"))).alias("starts"))
    found = found.withColumnsRenamed({"_id": "_at_id", "_text": "_at_text"})
    texts = keyed.select(*KEY, "text").filter("text IS NOT NULL")
    texts = texts.join(found, F.col("_id").eqNullSafe(F.col("_at_id")) & (F.col("_text") == F.col("_at_text")))
    # A word that begins a line carries its line break.
    texts = texts.select(*KEY, "starts", F.regexp_replace(F.btrim("text", F.lit(BLANKS)), BREAK, " \n").alias("text"))
    tokens = F.when(_odd("text"), F.split("text", r"[\x20\x09\x0B-\x0D]+", -1)).otherwise(F.split("text", " ", -1))
    texts = texts.select(*KEY, "starts", tokens.alias("tokens"))
    texts = texts.select(*KEY, "starts", "tokens", F.transform("tokens", lambda w: F.xxhash64(w)).alias("told"))
    # Windows are rows before they are hashed: code is generated for that, but none within a function over arrays.
    texts = texts.select(*KEY, "tokens", "told", F.explode("starts").alias("start"))
    # A break before the first word of a window does not count.
    bare = F.xxhash64(F.ltrim(F.get("tokens", F.col("start").cast("int")), F.lit("\n")))
    others = F.slice("told", F.col("start").cast("int") + 2, least_words - 1)
    return texts.select(*KEY, "start", (F.col("start") + (least_words - 1)).alias("end"), *_window_key(bare, others))


def repeated(windows: DataFrame) -> DataFrame:
    """Windows that occurred earlier: key columns, ``start``, ``end``. Repeated rows count once."""
    same, place = ["key", "check"], F.struct(*KEY, "start")
    # Hashes of places tell which keys have several; only their windows look for the first one.
    mark = F.xxhash64(*KEY, "start")
    twice = windows.groupBy(*same).agg(F.min(mark).alias("a"), F.max(mark).alias("z")).filter("a != z").select(*same)
    windows = windows.join(twice, same, "left_semi")
    first = windows.groupBy(*same).agg(F.min(place).alias("first"))
    return windows.join(first, same).filter(place != F.col("first")).select(*KEY, "start", "end")


def runs(repeats: DataFrame) -> DataFrame:
    """Repeated windows that overlap or touch as one run, all runs of a text as one array."""
    by_doc = W.partitionBy(*KEY).orderBy("start", "end")
    before = F.max("end").over(by_doc.rowsBetween(W.unboundedPreceding, -1))
    new = F.coalesce(F.col("start") > before + 1, F.lit(True)).cast("long")
    islands = repeats.withColumn("_new", new).withColumn("_run", F.sum("_new").over(by_doc.rowsBetween(W.unboundedPreceding, 0)))
    merged = islands.groupBy(*KEY, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return merged.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))


def _without(text: str, found: str) -> Column:
    """The text without its runs ``found``. What follows a run begins a line; a text that lost its beginning begins with a word."""
    run = lambda i: F.get(found, i)

    def joined(pieces: Column) -> Column:
        def between(i: Column) -> Column:
            since = F.when(i == 0, F.lit(0).cast("long")).otherwise(run(i - 1)["end"] + 1)
            until = F.coalesce(run(i)["start"], F.size(pieces).cast("long"))
            stay = F.slice(pieces, (since + 1).cast("int"), (until - since).cast("int"))
            told = F.array_join(stay, "")
            after_run = (i > 0) & ~F.contains(F.get(stay, F.lit(0)), F.lit("\n"))
            return F.when(after_run, F.concat(F.lit("\n"), F.ltrim(told, F.lit(BLANKS)))).otherwise(told)

        tail = F.substr(text, F.char_length(F.rtrim(text, F.lit(BLANKS))) + 1)
        last_goes = run(F.size(found) - 1)["end"] == F.size(pieces) - 1
        return F.concat(F.array_join(F.transform(F.sequence(F.lit(0), F.size(found)), between), ""), F.when(last_goes, "").otherwise(tail))

    # An array of one: its item is made once, however often it is used.
    kept = F.get(F.transform(F.array(_pieces(text)), joined), F.lit(0))
    return F.when(run(F.lit(0))["start"] == 0, F.ltrim(kept, F.lit(BLANKS))).otherwise(kept)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` without later copies of repeated runs; with ``n_lines`` (lines with a word before) and ``n_removed`` (fewer after).

    Words go with the blanks and line breaks before them. A null text stays null, with no lines. A null document number comes first.
    Rows that are wholly equal in number and text are one document: they lose the same words. Texts may become
    empty; no row goes. An empty table gives no rows. Input columns named ``n_lines`` or ``n_removed`` are replaced, all others
    come out as they were.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    keyed = _keyed(docs.select(*columns), id_col, text)
    lines = written(text_lines(keyed, least_words), "line-lines")
    prints = written(line_windows(lines, least_words), "line-prints")
    windows = written(near_lines(prints).union(near_words(keyed, lines, least_words)), "line-windows")
    gone = runs(repeated(windows)).withColumnsRenamed({"_id": "_gone_id", "_text": "_gone_text"})
    out = keyed.join(gone, F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_text") == F.col("_gone_text")), "left")
    out = out.select("row", "text", F.when(F.col("runs").isNull(), F.col("text")).otherwise(_without("text", "runs")).alias("kept"), F.col("runs").isNotNull().alias("cut"))
    has_word = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    count_of = lambda c: F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.size(F.filter(F.split(c, "\n", -1), has_word))).cast("long")
    out = out.withColumn("lines", count_of("text"))
    removed = F.when(F.col("cut"), F.col("lines") - count_of("kept")).otherwise(F.lit(0).cast("long"))
    shown = [F.col("kept").alias(c) if c == text else F.col("row")[c].alias(c) for c in columns]
    return out.select(*shown, F.col("lines").alias("n_lines"), removed.alias("n_removed"))
