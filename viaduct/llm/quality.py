"""Quality rules with thresholds that adapt to each language and source; built-in functions only.

Every document gets counts; from them ratios in thousandths. For each (lang, source) and ratio a mergeable quantile
sketch is kept: counts of values rounded down to six significant bits (relative error under 1/32), which add up over
partitions, files and days in any order and give the same result each time. A document is kept if each ratio is at most
the upper fence of its own group: Q3 + FENCE * max(Q3 - Q1, least spread). Groups of fewer than MIN_GROUP documents use
the sketch of all documents, so a rare language or source is not judged by itself.

Defined results: a null or empty text has no words and fails the base rules; null lang or source is a group of its own;
repeated rows each count and each get a verdict; a ratio equal to its fence passes; an empty table gives no rows; other
columns are carried through by keep().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, discard, settle

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
#: Upper fence: Q3 + FENCE * max(Q3 - Q1, least spread).
FENCE = 6
MIN_GROUP = 50
#: Ratio in thousandths and the least spread that its fence assumes.
SIGNALS = {"symbols_pm": 30, "dup_lines_pm": 30, "word_len_pm": 400, "repeat_pm": 20}


def words_of(text: Column) -> Column:
    """Words of a text: runs without white space."""
    flat = F.translate(F.coalesce(text, F.lit("")), WS_CHARS[1:], " " * 5)
    return F.array_remove(F.split(flat, " "), "")


def counts(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed; texts are read once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    window = f"transform(sequence(0, n_words - {WINDOW}), i -> xxhash64({', '.join(f'__w[i + {k}]' for k in range(WINDOW))}))"
    # Equal windows have equal hashes: as many hashes as windows means that none repeats. Only then are words compared.
    exact = f"sort_array(transform(sequence(0, n_words - {WINDOW}), i -> struct(concat_ws(' ', {', '.join(f'__w[i + {k}]' for k in range(WINDOW))}) as g, i as p)))"
    twice = "filter(__s, (x, j) -> (j > 0 and x.g = __s[j - 1].g) or (j + 1 < size(__s) and x.g = __s[j + 1].g))"
    covered = f"aggregate(sort_array(transform({twice}, x -> x.p)), struct(cast(0 as bigint) as n, cast(-{WINDOW} as bigint) as last), (a, p) -> struct(a.n + least({WINDOW}, p - a.last) as n, p as last), a -> a.n)"
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = held(docs, "__w", words_of(F.col("text"))).withColumn("n_words", F.size("__w").cast("long"))
    out = held(out, "__l", lines)
    out = held(out, "__h", F.when(F.col("n_words") > WINDOW, F.expr(window)))
    out = out.withColumn("__again", F.coalesce(F.size(F.array_distinct("__h")) < F.size("__h"), F.lit(False)))
    out = held(out, "__s", F.when(F.col("__again"), F.expr(exact)))
    numbers = F.struct(
        F.col("n_words"),
        F.char_length(F.translate(text, WS_CHARS, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("__again"), F.expr(covered)).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    out = held(out, "__n", numbers).select(*docs.columns, "__n.*")
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is computed once: Spark copies a projected expression to each place of use, also into the
    loops of array functions, but not one that a generator gives."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def signals(counted: DataFrame) -> DataFrame:
    """counted with each ratio of SIGNALS in thousandths, whole numbers."""
    per_word = lambda c: F.expr(f"({c} * 1000) div greatest(n_words, 1)")
    return (
        counted.withColumn("symbols_pm", per_word("n_symbols"))
        .withColumn("dup_lines_pm", per_word("n_dup_lines"))
        .withColumn("word_len_pm", per_word("word_chars"))
        .withColumn("repeat_pm", per_word("n_repeat_words"))
    )


def rounded(name: str) -> str:
    """A value with all but its six highest bits cleared."""
    shift = f"greatest(length(bin({name})) - 6, 0)"
    return f"shiftleft(shiftright({name}, {shift}), {shift})"


def sketches(signalled: DataFrame) -> DataFrame:
    """lang, source, signal, value, n: the mergeable sketches of documents that pass the base rules."""
    each = ", ".join(f"struct('{s}' as signal, {rounded(s)} as value)" for s in SIGNALS)
    rows = signalled.where("not base_failed").select("lang", "source", F.explode(F.expr(f"array({each})")).alias("x"))
    return rows.groupBy("lang", "source", "x.signal", "x.value").agg(F.count(F.lit(1)).alias("n"))


def merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """The sketch of both inputs."""
    return a.unionByName(b).groupBy("lang", "source", "signal", "value").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame) -> DataFrame:
    """lang, source and one fence_<signal> column for each signal, one row for each group of the sketch.

    Each group's sketch has at most a few hundred values, so a window over it is small whatever the input.
    """
    spark = sketch.sparkSession
    spread = " ".join(f"when '{s}' then {v}" for s, v in SIGNALS.items())
    quartile = "min(case when 4 * up >= {k} * total then value end)"
    by_group = """
        select lang, source, signal, any_value(total) as total, q3 + {fence} * greatest(q3 - q1, case signal {spread} end) as fence
        from (
            select lang, source, signal, any_value(total) as total, {q1} as q1, {q3} as q3
            from (
                select *, sum(n) over (partition by lang, source, signal order by value) as up,
                    sum(n) over (partition by lang, source, signal) as total
                from {{sketch}}
            ) group by lang, source, signal
        ) group by lang, source, signal, q1, q3""".format(fence=FENCE, spread=spread, q1=quartile.format(k=1), q3=quartile.format(k=3))
    own = spark.sql(by_group, sketch=sketch)
    everyone = sketch.groupBy("signal", "value").agg(F.sum("n").alias("n")).selectExpr("cast(null as string) as lang", "cast(null as string) as source", "signal", "value", "n")
    overall = spark.sql(by_group, sketch=everyone).select("signal", F.col("fence").alias("all_fence"))
    both = own.join(overall, "signal").withColumn("fence", F.when(F.col("total") >= MIN_GROUP, F.col("fence")).otherwise(F.col("all_fence")))
    each = [F.max(F.when(F.col("signal") == s, F.col("fence"))).alias(f"fence_{s}") for s in SIGNALS]
    return both.groupBy("lang", "source").agg(*each)


def judged(signalled: DataFrame, sketch: DataFrame) -> DataFrame:
    """signalled with kept: the base rules passed and every ratio at most its group's fence."""
    own = fences(sketch).select(F.struct("lang", "source").alias("__group"), *[f"fence_{s}" for s in SIGNALS])
    fine = ~F.col("base_failed")
    for s in SIGNALS:
        fine = fine & F.coalesce(F.col(s) <= F.col(f"fence_{s}"), F.lit(True))
    # Structs join null with null. Spark's adaptive plan broadcasts the fences if their measured size allows; else it
    # shuffles and splits the partitions of a hot group.
    keyed = signalled.withColumn("__group", F.struct("lang", "source"))
    return keyed.join(own, "__group", "left").withColumn("kept", fine).drop("__group", *[f"fence_{s}" for s in SIGNALS])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed and kept."""
    base = settle(signals(counts(docs.select("doc_id", "text", "lang", "source"))).drop("text"), "quality")
    out = judged(base, settle(sketches(base), "sketch"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns.

    The counts are made once and written with a digest of the text; the rejected rows' keys then meet the documents in an
    anti-join. The key has the doc_id, so that copies of one text spread over the shuffle.
    """
    key = ["doc_id", "digest", "lang", "source"]
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("digest")
    counted = signals(counts(docs.select("doc_id", "text", "lang", "source"))).select("doc_id", digest, "lang", "source", "base_failed", *SIGNALS)
    base = settle(counted, "quality")
    sketch = settle(sketches(base), "sketch")
    rejected = settle(judged(base, sketch).where("not kept").select(*key), "rejected")
    discard(base, sketch)
    tagged = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", digest, "lang", "source")
    same = F.lit(True)
    for c in key:
        same = same & tagged[c].eqNullSafe(rejected[c])
    return tagged.join(rejected, same, "left_anti").select("doc.*")
