"""Quality rules whose cuts come from the data: quantile sketches per language and source.

Every document gets a few whole-number signals. Per group (language and source) and signal a sketch
counts the documents by value, values rounded down to seven leading bits, so that a quantile read from
it is at most 1/64 too small. Sketches of disjoint rows are merged by adding their counts: partial sums
before the shuffle, sources into languages, languages into the whole, old batches with new ones. A
group's cuts lie `reach` spreads to either side of its median, a spread being the distance to the nearer
quartile: up to half of a group may be junk without moving its own cuts beyond the junk. Groups of fewer than
`enough` documents take the cuts of their language, small languages those of the whole. The cuts are
joined back to the documents. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltmart.session import cut_lineage

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
NOT_SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 5  # words of a window that may repeat
MIN_WORDS = 10
MAX_REPEATED = 20  # per cent of the words
BITS = 7  # leading bits of a value that its sketch keeps
REACH = 6  # spreads between a group's median and its cuts
ENOUGH = 100  # documents that make a group's own cuts
GROUP = ("lang", "source")
# Signals, in hundredths: the smallest spread taken for each, so that a group of equal values has room.
LEAST_SPREADS = {"word_length": 25, "symbol_share": 100, "dup_line_share": 500, "repeat_share": 200}
TWO_SIDED = ("word_length",)


def _repeated_words(hashes: Column) -> Column:
    """Words inside windows found twice or more, given the windows' hashes in text order."""

    def covered(ordered: Column) -> Column:
        twice = F.filter(
            ordered,
            lambda x, k: (x["h"] == F.get(ordered, k - 1)["h"]) | (x["h"] == F.get(ordered, k + 1)["h"]),
        )
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        none = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            starts,
            none,
            lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # The one-element array binds the sorted windows once instead of once per window.
    found = F.get(F.transform(F.array(ordered), covered), F.lit(0))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), found).otherwise(F.lit(0).cast("long"))


def signals(docs: DataFrame, by: tuple[str, ...] = GROUP, text: str = "text") -> DataFrame:
    """(doc_id, text, *by) -> (doc_id, *by, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words), all counts long, one row per row of docs, from whole texts; null text: no words.

    Words are what white space of ASCII sets apart; n_lines are the lines with a word, n_dup_lines those
    equal to an earlier one. Windows of five words are told apart by 64-bit hashes within their text. The
    work of a row is n log n in its words and its memory in proportion to them. Nothing is shuffled.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select("doc_id", *by, body.alias("_text"))
    parts = rows.select(
        "doc_id", *by, "_text",
        F.array_remove(F.split("_text", SPACE, -1), "").alias("_words"),
        F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(NOT_SPACE)).alias("_lines"),
    )
    last = F.size("_words") - WINDOW
    window = lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)])
    hashed = parts.withColumn(
        "_hashes",
        F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), window)).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    count = lambda c: c.cast("long")
    return hashed.select(
        "doc_id", *by,
        count(F.size("_words")).alias("n_words"),
        count(F.length(F.array_join("_words", ""))).alias("word_chars"),
        count(F.length(F.regexp_replace("_text", NOT_SYMBOLS, ""))).alias("n_symbols"),
        count(F.size("_lines")).alias("n_lines"),
        count(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        _repeated_words(F.col("_hashes")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    words, repeated = F.col("n_words"), F.col("n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEATED * words)


def _share(part: str, whole: str, scale: int) -> Column:
    return F.when(F.col(whole) > 0, F.expr(f"({scale} * {part}) div {whole}")).otherwise(F.lit(0).cast("long"))


def values() -> dict[str, Column]:
    """The signals that are cut, as whole numbers: mean word length and three shares, in hundredths
    (of a code point, of a per cent)."""
    return {
        "word_length": _share("word_chars", "n_words", 100),
        "symbol_share": _share("n_symbols", "word_chars", 10_000),
        "dup_line_share": _share("n_dup_lines", "n_lines", 10_000),
        "repeat_share": _share("n_repeat_words", "n_words", 10_000),
    }


def sketch(rows: DataFrame, by: tuple[str, ...], measured: dict[str, Column]) -> DataFrame:
    """Quantile sketches (*by, signal, low, n): n rows of the group have a value from `low` up to the next
    bucket. Values are whole and not negative; rows are summed before they are shuffled, and a sketch
    has at most 64 buckets per doubling of the value, whatever the group's size."""
    named = F.explode(F.array(*[F.struct(F.lit(k).alias("signal"), v.alias("v")) for k, v in measured.items()]))
    width = F.expr(f"shiftleft(1L, greatest(length(bin(_s.v)) - {BITS}, 0))")
    low = F.col("_s.v") - F.col("_s.v") % width
    return (
        rows.select(*by, named.alias("_s"))
        .groupBy(*by, F.col("_s.signal").alias("signal"), low.alias("low"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge(sketches: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Merge sketches into those of coarser groups, or the sketches of several batches of rows."""
    return sketches.groupBy(*by, "signal", "low").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(*by, signal, docs, q1, q2, q3) read from the sketches; a window sees one group's buckets."""
    group = Window.partitionBy(*by, "signal")
    upto = sketches.select(
        *by, "signal", "low", F.sum("n").over(group).alias("docs"),
        F.sum("n").over(group.orderBy("low")).alias("upto"),
    )
    reached = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("docs"), F.col("low")))
    return upto.groupBy(*by, "signal").agg(
        F.max("docs").alias("docs"), *[reached(q).alias(f"q{q}") for q in (1, 2, 3)]
    )


def cuts(sketches: DataFrame, by: tuple[str, ...] = GROUP, reach: int = REACH, enough: int = ENOUGH) -> DataFrame:
    """(*by, signal, lowest, highest) per group of the sketches: the group's own cuts where it has `enough`
    documents, else those of the groups it belongs to, from the right end of `by` inwards."""
    least = F.create_map(*[F.lit(x) for pair in LEAST_SPREADS.items() for x in pair])

    def fenced(depth: int) -> DataFrame:
        keys = by[:depth]
        spread = F.greatest(F.least(F.col("q2") - F.col("q1"), F.col("q3") - F.col("q2")), least[F.col("signal")])
        return quartiles(sketches if depth == len(by) else merge(sketches, keys), keys).select(
            *[F.col(k).alias(f"{k}{depth}") for k in keys], F.col("signal").alias(f"signal{depth}"),
            F.when((F.col("docs") >= enough) | F.lit(depth == 0), F.struct(
                F.when(F.col("signal").isin(*TWO_SIDED), F.col("q2") - reach * spread)
                .otherwise(F.lit(-1).cast("long")).alias("lowest"),
                (F.col("q2") + reach * spread).alias("highest"),
            )).alias(f"cut{depth}"),
        )

    found = sketches.select(*by, "signal").distinct()
    for depth in range(len(by), -1, -1):
        level = fenced(depth)
        same = level[f"signal{depth}"] == found["signal"]
        for key in by[:depth]:
            same = same & level[f"{key}{depth}"].eqNullSafe(found[key])
        found = found.join(level, same, "left").select(found["*"], level[f"cut{depth}"])
    best = F.coalesce(*[f"cut{depth}" for depth in range(len(by), -1, -1)])
    return found.select(*by, "signal", best["lowest"].alias("lowest"), best["highest"].alias("highest"))


def judge(
    docs: DataFrame, by: tuple[str, ...] = GROUP, reach: int = REACH, enough: int = ENOUGH, text: str = "text"
) -> DataFrame:
    """(doc_id, text, *by, ...) -> the signals of every row, base_failed and kept; one row per row of docs.

    base_failed: fewer than ten words, or over 20 per cent of them in windows of five that repeat. The
    sketches are taken over the rows that pass; kept rows pass and lie within their group's cuts. A null
    language or source is a value like any other. Null and empty texts and texts of white space fail.
    Equal rows are counted and judged one by one, all alike. No rows: none. Columns of docs other than doc_id, text
    and `by` are not looked at.
    """
    rows = cut_lineage(signals(docs, by, text).withColumn("base_failed", base_failed()), "signals")
    measured = values()
    sketches = cut_lineage(sketch(rows.where(~F.col("base_failed")), by, measured), "sketches")
    sides = [
        F.max(F.when(F.col("signal") == name, F.col(side))).alias(f"_{side}_{name}")
        for name in measured
        for side in ("lowest", "highest")
    ]
    limits = cuts(sketches, by, reach, enough).groupBy(*[F.col(k).alias(f"_{k}") for k in by]).agg(*sides)
    same = F.lit(True)
    for key in by:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    inside = F.lit(True)
    for name, value in measured.items():
        inside = inside & value.between(F.col(f"_lowest_{name}"), F.col(f"_highest_{name}"))
    return rows.join(limits, same, "left").select(
        *rows.columns, (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept")
    )


def keep_good(docs: DataFrame, by: tuple[str, ...] = GROUP, text: str = "text") -> DataFrame:
    """The rows of docs that the rules keep, with all their columns: each row's signals and verdict depend
    on its text and group alone, so they are joined back by these. Null texts are never kept."""
    marks = [F.xxhash64(text, *by), F.md5(F.col(text))]
    tagged = docs.where(F.col(text).isNotNull()).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.struct(*marks).alias("doc_id"), F.col(text).alias(text), *[F.col(k) for k in by],
    )
    good = judge(tagged, by, text=text).where("kept").select("doc_id").distinct()
    return tagged.select("doc_id", "_row").join(good, "doc_id", "left_semi").select("_row.*")


# ---- the same in DuckDB's SQL --------------------------------------------------------------------


def oracle() -> str:
    """SQL for the contract columns of judge(documents)."""
    spreads = " ".join(f"WHEN '{k}' THEN {v}" for k, v in LEAST_SPREADS.items())
    share = lambda a, b, scale: f"CASE WHEN {b} > 0 THEN {scale} * {a} // {b} ELSE 0 END"
    levels = ""
    for depth, keys in enumerate(("", "lang,", "lang, source,")):
        levels += f"""
    u{depth} AS (SELECT {keys} signal, low, sum(sum(n)) OVER w AS upto, sum(sum(n)) OVER g AS docs FROM sk
      GROUP BY {keys} signal, low WINDOW w AS (PARTITION BY {keys} signal ORDER BY low), g AS (PARTITION BY {keys} signal)),
    q{depth} AS (SELECT {keys} signal, max(docs) AS docs, min(low) FILTER (4 * upto >= docs) AS q1,
      min(low) FILTER (4 * upto >= 2 * docs) AS q2, min(low) FILTER (4 * upto >= 3 * docs) AS q3
      FROM u{depth} GROUP BY {keys} signal),
    l{depth} AS (SELECT *, greatest(least(q2 - q1, q3 - q2), CASE signal {spreads} END) AS spread FROM q{depth}
      {f"WHERE docs >= {ENOUGH}" if depth else ""}),"""
    return f"""
    WITH rows AS (
      SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents
    ), parts AS (
      SELECT *, list_filter(regexp_split_to_array(text, '{SPACE}'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{NOT_SPACE}')) AS lines FROM rows
    ), windows AS (
      SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS w
      FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM parts)
    ), twice AS (
      SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
    ), repeated AS (
      SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY r
    ), counted AS (
      SELECT r, doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '{NOT_SYMBOLS}', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
      FROM parts LEFT JOIN repeated USING (r)
    ), d AS (
      SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM counted
    ), v AS (
      SELECT r, lang, source, base_failed, unnest([
        {{'signal': 'word_length', 'v': {share('word_chars', 'n_words', 100)}}},
        {{'signal': 'symbol_share', 'v': {share('n_symbols', 'word_chars', 10_000)}}},
        {{'signal': 'dup_line_share', 'v': {share('n_dup_lines', 'n_lines', 10_000)}}},
        {{'signal': 'repeat_share', 'v': {share('n_repeat_words', 'n_words', 10_000)}}}]) AS s FROM d
    ), sk AS (
      SELECT lang, source, s.signal AS signal, s.v - s.v % (1::BIGINT << greatest(length(bin(s.v)) - {BITS}, 0)) AS low,
        count(*)::BIGINT AS n FROM v WHERE NOT base_failed GROUP BY ALL
    ),{levels}
    judged AS (
      SELECT d.r, bool_and(
        (d.s.signal NOT IN ({", ".join(f"'{s}'" for s in TWO_SIDED)})
          OR d.s.v >= coalesce(l2.q2 - {REACH} * l2.spread, l1.q2 - {REACH} * l1.spread, l0.q2 - {REACH} * l0.spread))
        AND d.s.v <= coalesce(l2.q2 + {REACH} * l2.spread, l1.q2 + {REACH} * l1.spread, l0.q2 + {REACH} * l0.spread)
      ) AS inside
      FROM v d JOIN l0 ON l0.signal = d.s.signal
      LEFT JOIN l1 ON l1.lang IS NOT DISTINCT FROM d.lang AND l1.signal = d.s.signal
      LEFT JOIN l2 ON l2.lang IS NOT DISTINCT FROM d.lang AND l2.source IS NOT DISTINCT FROM d.source
        AND l2.signal = d.s.signal
      GROUP BY d.r
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND coalesce(inside, false) AS kept
    FROM d LEFT JOIN judged USING (r)
    """
