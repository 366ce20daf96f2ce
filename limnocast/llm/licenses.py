"""Licences of documents: TF-IDF cosine of runs of lines and of whole files to templates, then inheritance from directories.

Everything here is DataFrame and SQL functions.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnocast.llm.licence_texts import FILES, NOTICES
from limnocast.llm.vectors import with_sizes
from limnocast.session import checkpointed

#: A run of lines is a notice, and the beginning of a text that of a licence file, from the first cosine on; a whole text
#: is mostly a licence from the second on.
LINE_COSINE, FILE_COSINE = 0.8, 0.5
#: A term in a smaller share of documents than one in so many weighs no more, so weights do not grow with the corpus.
RAREST = 10_000
#: Lines of a text whose runs are listed at a time.
CHUNK_LINES = 500

#: What separates terms, in a lower-cased text.
SEPARATORS = "[^a-z0-9]+"


def words_of(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.lower()) if w]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SEPARATORS), lambda w: w != "")


def _literal(words: list[str]) -> Column:
    return F.array(*(F.lit(w) for w in words)).cast("array<string>")


def idf(held: int, number: int) -> float:
    """Weight of a term in ``held`` of ``number`` documents: from 1 for one in all to 2 for the rarest."""
    return 1 + min(math.log((1 + number) / (1 + held)), math.log(RAREST)) / math.log(RAREST)


def _idf(held: Column, number: int) -> Column:
    return 1 + F.least(F.log((1 + F.lit(number)) / (1 + held)), F.lit(math.log(RAREST))) / math.log(RAREST)


def vector(words: list[str], weight: dict[str, float]) -> dict[str, float]:
    """Weights of the terms of a template: its counts by their logarithm, times the terms' rarity."""
    return {w: (1 + math.log(n)) * weight[w] for w, n in sorted(Counter(words).items())}


def leading_terms(vectors: list[dict[str, float]], cosine: float, held: dict[str, int]) -> list[str]:
    """Terms of which every vector that reaches ``cosine`` to one of ``vectors`` holds one.

    By Cauchy and Schwarz the terms shared with a template must carry ``cosine ** 2`` of its squared length. So
    its terms, those that the fewest documents hold first, are taken until the others carry less than that.
    """
    out: set[str] = set()
    for weights in vectors:
        order = sorted(weights, key=lambda w: (held.get(w, 0), -weights[w], w))
        left = sum(x * x for x in weights.values())
        least = cosine**2 * left * (1 - 1e-9)
        for word in order:
            if left < least:
                break
            out.add(word)
            left -= weights[word] ** 2
    return sorted(out)


def longest_run(notices: list[list[str]], cosine: float) -> int:
    """Words up to which runs are compared: those of the longest notice, with room for what a cosine lets pass beside it."""
    return math.ceil(max((len(n) for n in notices), default=0) / cosine**2)


def scan(
    docs: DataFrame,
    path: Column,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    files: tuple[tuple[str, str], ...] = FILES,
    line_cosine: float = LINE_COSINE,
    file_cosine: float = FILE_COSINE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, path, license, basis, cosine, notices, from_dir)`` for each row of ``docs``.

    Terms are lower-cased words; a vector holds ``1 + ln(count)`` of each, times a weight by the share of documents that hold the term,
    counted over all words of all documents (see ``idf``). Of every whole text, lines without a word aside, each run of consecutive lines of up to
    ``longest_run`` words, and each longer line, that begins and ends with a line that shares a word with a notice is compared with the notices.
    For each line the best run over it counts (of equals the shorter, the earlier, the name that sorts first): with
    ``line_cosine`` or more it is a notice of its licence. A text is a licence file if its beginning, as many words as the
    opening in ``files`` has, reaches ``line_cosine`` to that opening and the whole text reaches ``file_cosine``: so a source file with a
    head, or a few lines with a notice, is none. A file speaks for its
    directory: the licence that most files there name, of equals the one that sorts first.

    ``license`` is that of the file (basis ``file``, ``cosine`` of its beginning) or of the best notice (``notice``), of equals the one that
    sorts first; else it is inherited from the nearest directory above that has one
    (``inherited``, ``from_dir``), else null. ``notices`` lists the licences of all notices. A null or empty text has no terms; a null
    path lies in the root directory, the empty string. Repeated rows each get a row; other columns are not read. An empty table gives an empty result.

    The driver holds only the templates and one number for each of their terms.
    """
    told = [(licence, words_of(text)) for licence, text in notices]
    opened = [(licence, words_of(text)) for licence, text in files]
    used = sorted({w for _, ws in (*told, *opened) for w in ws})

    # Documents that hold each word, and with no word the number of all documents.
    present = docs.select(F.explode(F.concat(F.array_distinct(_words(F.coalesce(text_col, F.lit("")))), F.array(F.lit("")))).alias("term"))
    counts = checkpointed(present.groupBy("term").agg(F.count("*").alias("n")))
    few = {r["term"]: r["n"] for r in counts.where(F.col("term").isin([*used, ""])).collect()}
    number = few.get("", 0)
    weight = {w: idf(few.get(w, 0), number) for w in used}
    told_vectors = [vector(ws, weight) for _, ws in told]
    opened_vectors = [vector(ws, weight) for _, ws in opened]

    where = F.coalesce(path, F.lit(""))
    words = _words(F.col(text_col))
    leads = _literal(leading_terms(told_vectors, line_cosine, few))
    file_leads = _literal(leading_terms(opened_vectors, line_cosine, few))
    lines = F.filter(F.transform(F.split(text_col, "\n"), _words), lambda x: F.size(x) > 0)
    held = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        where.alias("path"),
        F.regexp_replace(where, "(?s)/?[^/]*$", "").alias("dir"),
        F.col(text_col),
        words.alias("words"),
    ).select(
        "row", "id", "path", "dir",
        F.when(F.arrays_overlap("words", leads), lines).alias("lines"),
        F.when(F.arrays_overlap("words", file_leads), F.col("words")).alias("file"),
    )
    held = checkpointed(held)

    known = _literal(sorted({w for v in told_vectors for w in v}))
    runs = _runs(held.where("lines is not null").select("row", "lines"), known, leads, longest_run([ws for _, ws in told], line_cosine))
    sizes = _literal([]).cast("array<int>") if not opened else F.array(*[F.lit(len(ws)) for _, ws in opened])
    starts = held.where("file is not null").select("row", "file", F.posexplode(sizes).alias("template", "size"))
    units = (
        runs.select("row", F.lit("run").alias("kind"), F.lit(None).cast("int").alias("template"), "first", "last", "words")
        .union(starts.select("row", F.lit("start"), "template", F.lit(0), F.lit(0), F.slice("file", F.lit(1), F.col("size"))))
        .union(held.where("file is not null").select("row", F.lit("whole"), F.lit(None), F.lit(0), F.lit(0), "file"))
    )
    units = checkpointed(units.withColumn("bag", F.md5(F.array_join(F.array_sort("words"), " "))))
    told_of = [("told", i, licence, v) for i, ((licence, _), v) in enumerate(zip(told, told_vectors, strict=True))]
    opened_of = [("opened", i, licence, v) for i, ((licence, _), v) in enumerate(zip(opened, opened_vectors, strict=True))]
    near = checkpointed(_cosines(units, counts, number, [*told_of, *opened_of], min(line_cosine, file_cosine)))

    # A bag that many rows share meets its row of cosines in many tasks.
    found = with_sizes(units.drop("words"), near, ["bag"], "row")
    hits = F.filter("hits", lambda h: (h["side"] == "told") & (h["cosine"] >= line_cosine))
    best_hit = F.array_min(F.transform(hits, lambda h: F.struct((-h["cosine"]).alias("cosine"), h["licence"].alias("licence"))))
    noticed = found.where("kind = 'run'").withColumn("hit", best_hit).where("hit is not null")
    per_line = noticed.select(
        "row", F.explode(F.sequence("first", "last")).alias("line"),
        F.struct("hit.cosine", (F.col("last") - F.col("first")).alias("long"), "first", "hit.licence").alias("rank"),
    ).groupBy("row", "line").agg(F.min("rank").alias("rank"))
    spoken = per_line.groupBy("row").agg(
        F.min(F.struct("rank.cosine", "rank.licence")).alias("notice"), F.array_sort(F.collect_set("rank.licence")).alias("notices")
    )
    mine = F.filter("hits", lambda h: (h["side"] == "opened") & (h["template"] == F.col("unit_template")) & (h["cosine"] >= line_cosine))
    start = found.where("kind = 'start'").withColumn("unit_template", F.col("template")).select("row", F.inline(mine))
    whole = found.where("kind = 'whole'").select("row", F.inline("hits")).where((F.col("side") == "opened") & (F.col("cosine") >= file_cosine))
    filed = start.select("row", "template", "licence", "cosine").join(whole.select("row", "template"), ["row", "template"])
    filed = filed.groupBy("row").agg(F.min(F.struct((-F.col("cosine")).alias("cosine"), "licence")).alias("file"))
    own = checkpointed(spoken.join(filed, "row", "full"))

    rows = held.select("row", "id", "path", "dir").join(own, "row", "left")
    filed_dirs = held.select("row", "dir").join(own.where("file is not null"), "row")
    heirs = _inherited(filed_dirs.select("dir", "file.licence"), held.select("dir").distinct())
    rows = rows.join(heirs, "dir", "left")
    none = F.col("file").isNull() & F.col("notice").isNull()
    return rows.select(
        F.col("id").alias(id_col),
        "path",
        F.coalesce("file.licence", "notice.licence", "licence").alias("license"),
        F.when(F.col("file").isNotNull(), "file").when(F.col("notice").isNotNull(), "notice").when(F.col("licence").isNotNull(), "inherited").alias("basis"),
        (-F.coalesce("file.cosine", "notice.cosine")).alias("cosine"),
        F.coalesce(F.array_join("notices", ","), F.lit("")).alias("notices"),
        F.when(none, F.col("from_dir")).alias("from_dir"),
    )


def _runs(rows: DataFrame, known: Column, leads: Column, longest: int) -> DataFrame:
    """``(row, first, last, words)`` of the runs of ``rows(row, lines)`` that may be notices.

    A run begins and ends with a line that shares a word with a notice, holds a leading term, and has ``longest`` words at most
    or one line. Texts are cut into chunks of lines that overlap by what a run can reach, so one of many lines does not list all its runs in one row.
    """
    size = F.size("lines")
    chunks = F.sequence(F.lit(0), F.floor((size - 1) / CHUNK_LINES).cast("int"))
    cut = F.transform(
        chunks,
        lambda c: F.struct((c * CHUNK_LINES).alias("base"), F.slice("lines", c * CHUNK_LINES + 1, F.lit(CHUNK_LINES + longest)).alias("part")),
    )
    part = rows.where(size > 0).select("row", F.inline(cut))
    part = part.where(F.exists("part", lambda x: F.arrays_overlap(x, leads))).select(
        "row", "base", "part",
        F.transform("part", F.size).alias("sizes"),
        F.transform("part", lambda x: F.arrays_overlap(x, known)).alias("known"),
        F.transform("part", lambda x: F.arrays_overlap(x, leads)).alias("lead"),
    )
    # Words up to each line, by which the last line that a run can reach is found.
    upto = F.expr("transform(sizes, (s, i) -> aggregate(slice(sizes, 1, i + 1), 0, (a, x) -> a + x))")
    listed = F.expr(
        f"flatten(transform(sequence(1, least(size(part), {CHUNK_LINES})), a -> transform(filter(sequence(a, least(size(part), a + {longest})), b -> "
        f"known[a - 1] AND known[b - 1] AND (a = b OR upto[b - 1] - upto[a - 1] + sizes[a - 1] <= {longest}) "
        "AND exists(slice(lead, a, b - a + 1), x -> x)), b -> named_struct('first', base + a, 'last', base + b, "
        "'words', flatten(slice(part, a, b - a + 1))))))"
    )
    return part.withColumn("upto", upto).select("row", F.inline(listed))


def _cosines(
    units: DataFrame, counts: DataFrame, number: int, templates: list[tuple[str, int, str, dict[str, float]]], least: float
) -> DataFrame:
    """``(bag, hits)`` of each distinct bag of words: the templates it has ``least`` cosine to, rounded to 9 places."""
    spark = units.sparkSession
    entries = [(side, i, licence, w, x, math.sqrt(sum(y * y for y in v.values()))) for side, i, licence, v in templates for w, x in v.items()]
    entry = spark.createDataFrame(entries, "side string, template int, licence string, term string, value double, length double")
    bags = units.groupBy("bag").agg(F.first("words").alias("words"))
    parts = bags.select("bag", F.explode("words").alias("term")).groupBy("bag", "term").agg(F.count("*").alias("times"))
    parts = checkpointed(parts)
    # The document counts of the words in question only; a common one meets its bags in many tasks.
    wanted = counts.join(parts.select("term").distinct(), "term", "left_semi")
    weighted = with_sizes(parts, wanted, ["term"], "bag").select(
        "bag", "term", ((1 + F.log("times")) * _idf(F.col("n"), number)).alias("own")
    )
    squares = weighted.groupBy("bag").agg(F.sum(F.col("own") * F.col("own")).alias("square"))
    # As large as the templates given, and no larger.
    dots = weighted.join(F.broadcast(entry), "term").groupBy("bag", "side", "template", "licence", "length")
    dots = dots.agg(F.sum(F.col("own") * F.col("value")).alias("dot")).join(squares, "bag")
    cosine = F.round(F.col("dot") / (F.col("length") * F.sqrt("square")), 9).alias("cosine")
    hits = dots.select("bag", "side", "template", "licence", cosine).where(F.col("cosine") >= least)
    return hits.groupBy("bag").agg(F.collect_list(F.struct("side", "template", "licence", "cosine")).alias("hits"))


def _inherited(files: DataFrame, dirs: DataFrame) -> DataFrame:
    """``(dir, licence, from_dir)`` for each of ``dirs`` that has a licence file in it or above; ``files`` has dir and licence."""
    votes = files.groupBy("dir", "licence").agg(F.count("*").alias("n"))
    spoken = votes.groupBy("dir").agg(F.min(F.struct((-F.col("n")).alias("n"), "licence")).alias("vote"))
    spoken = spoken.select(F.col("dir").alias("from_dir"), "vote.licence")
    parts = F.split("dir", "/")
    # The directory itself, those above it, and the root.
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    climbs = dirs.select("dir", F.explode(F.array_distinct(above)).alias("from_dir"))
    nearest = climbs.join(spoken, "from_dir").groupBy("dir").agg(
        F.max(F.struct(F.length("from_dir").alias("long"), "from_dir", "licence")).alias("near")
    )
    return nearest.select("dir", "near.licence", "near.from_dir")
