"""Spelling variant grouping over a reduced alphabet.

1. Words are counted over all texts (runs of letters, A-Z lowered), pre-aggregated in the tasks.
2. Letters become a few symbols. Each reduced word's one-edit neighbourhood is generated in full, each pair of neighbours from one
   side only: the word itself, every symbol replaced by each smaller one, every symbol deleted (an insertion is a deletion of the other).
3. Neighbours meet the reduced vocabulary. An edit in one half of a word leaves the letters of the other half alone, and the place of the
   edit is known here: the key also holds that other half as it is written. So a reduced word that many words share is
   split by their halves, and no key has all pairs of such a group. Words of more than 64 letters meet by equal halves alone.
4. Pairs of a key are verified on the words themselves inside the join (edit distance 1); only true pairs leave it.
5. Each word's form is its most frequent near word, where that is `ratio` times as frequent. Forms are followed by pointer doubling:
   counts grow by `ratio` at each step, so a few rounds reach every root.

Words: maximal runs of A-Z, a-z and U+00C0 to U+00FF, at least `shortest` letters long after the change below and `at_least` times in all texts.
If 31 divides the crc32 of `<id>:<run>`, the run loses the letter at crc32 % length, as its typing error (`every`; 0: none).

Result: word, form, root, n, n_near, form_n. A null text has no words, a null id counts as empty in `<id>:`. Ties of n go to the word that is
smaller in code points. Rows that repeat count each. Long texts are one regular expression's work, linear in their length. Other
columns aren't read. Without words there are no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evgraph.llm.common import with_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters by how common they are in English; dealt to the symbols in turn, so that each symbol stands for a like share of text.
BY_USE = "etaoinshrdlcumwfgypbvkjxqz"
SYMBOLS = "0123456789"
#: Longer words meet by their exact halves alone: these tell more than a reduced word, whose neighbourhood is quadratic in its length.
LONG = 64
#: n grows by the ratio at each step from a word to its form, so a chain of forms is at most log2(2**63) long for a ratio of 2 or more.
DOUBLINGS = 6


def reduced(word: Column, symbols: int) -> Column:
    letters = BY_USE + "".join(map(chr, range(0xC0, 0x100)))
    there_and_back = [*range(symbols), *reversed(range(symbols))]
    to = "".join(SYMBOLS[there_and_back[i % len(there_and_back)]] for i in range(len(BY_USE))) + "".join(SYMBOLS[c % symbols] for c in range(0xC0, 0x100))
    return F.translate(word, letters, to)


def vocabulary(docs: DataFrame, shortest: int = 7, at_least: int = 2, every: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n."""
    runs = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit("[a-z\\u00C0-\\u00FF]{%d,}" % shortest), F.lit(0))
    each = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    if every:
        h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        at = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
        each = each.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("run")).where(F.length("run") >= shortest)
    return each.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= at_least)


def start(word: Column, size: Column) -> Column:
    return F.substring(word, F.lit(1), size)


def rest(word: Column, after: Column) -> Column:
    return F.substring(word, after + 1, F.length(word))


def key(longest: Column, side: Column, half: Column, neighbour: Column) -> Column:
    """One number for: the length of the pair's longer word, which half is the same in both (last bit), that half, and a reduced word."""
    return F.shiftleft(F.xxhash64(longest, half, neighbour), 1) + side


def near_pairs(words: DataFrame, symbols: int = 4) -> DataFrame:
    """a, n_a, b, n_b: each pair of words that differ by one inserted, deleted or replaced letter, once."""
    own = words.select("word", "n", F.length("word").alias("size"), reduced(F.col("word"), symbols).alias("r"))
    c, first, second = F.col, F.lit(0), F.lit(1)
    half = F.expr("div(size, 2)").cast("int")
    short = c("size") <= LONG
    places = F.when(short, F.sequence(F.lit(0), c("size") - 1)).otherwise(F.array().cast("array<int>"))
    told = lambda longest: F.when(longest <= LONG, c("r")).otherwise("")

    # the words that are met: by words of their own length, and by words longer by a letter
    longer = F.expr("div(size + 1, 2)").cast("int")
    same = F.array(key(c("size"), first, start(c("word"), half), told(c("size"))), key(c("size"), second, rest(c("word"), half), told(c("size"))))
    one_less = F.array(key(c("size") + 1, first, start(c("word"), longer), told(c("size") + 1)), key(c("size") + 1, second, rest(c("word"), longer - 1), told(c("size") + 1)))
    met = F.concat(same, one_less)
    met = own.select(F.explode(F.array_distinct(met)).alias("key"), c("word").alias("b"), c("n").alias("n_b"))

    # the neighbourhoods: an edit in the second half leaves the first as it is, and the other way round
    side = lambda p: F.when(p >= half, first).otherwise(second)
    kept = lambda p: F.when(p >= half, start(c("word"), half)).otherwise(rest(c("word"), half))
    without = lambda p: F.concat(start(c("r"), p), rest(c("r"), p + 1))
    symbol = lambda p: F.substring(c("r"), p + 1, F.lit(1))
    deleted = F.transform(places, lambda p: key(c("size"), side(p), kept(p), without(p)))
    put = lambda s: lambda p: key(c("size"), side(p), kept(p), F.concat(start(c("r"), p), F.lit(s), rest(c("r"), p + 1)))
    larger = lambda s: lambda p: symbol(p) > s
    replaced = [F.transform(F.filter(places, larger(s)), put(s)) for s in SYMBOLS[: symbols - 1]]
    meets = own.select(F.explode(F.array_distinct(F.concat(same, deleted, *replaced))).alias("key"), c("word").alias("a"), c("n").alias("n_a"))

    size_a, size_b = F.length("a"), F.length("b")
    replaced_once = (c("a") < c("b")) | (size_a <= LONG) & (reduced(c("a"), symbols) != reduced(c("b"), symbols))
    # a letter deleted from a run of equal ones that crosses the middle is met in both halves: the first one counts
    middle = F.expr("div(length(a), 2)").cast("int")
    deleted_once = (c("key").bitwiseAND(1) == 0) | (start(c("a"), middle) != start(c("b"), middle))
    once = F.when(size_a == size_b, replaced_once).otherwise(deleted_once)
    return meets.join(met, "key").where((F.levenshtein("a", "b", 1) == 1) & once).select("a", "n_a", "b", "n_b")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word that forms (word, form) lead to. Every form has a larger count than its word, so there are no cycles."""
    found = forms.select("word", F.col("form").alias("root")).checkpoint()
    for _ in range(DOUBLINGS):
        on = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = found.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")).checkpoint()
        found = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return found
    if found.join(found.select(F.col("word").alias("root")), "root", "left_semi").limit(1).count():
        raise RuntimeError(f"forms did not settle in {DOUBLINGS} rounds")
    return found


def group(docs: DataFrame, symbols: int = 4, ratio: int = 10, **options) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    with_checkpoint_dir(docs.sparkSession)
    words = vocabulary(docs, **options).checkpoint()
    pairs = near_pairs(words, symbols).checkpoint()
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    best = F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("b")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.first("n_a").alias("n_a"), F.count("*").alias("n_near"), best.alias("best"))
    large = -F.col("best.less") >= ratio * F.col("n_a")
    near = near.select("word", "n_near", F.when(large, F.col("best.b")).alias("form"), F.when(large, -F.col("best.less")).alias("form_n")).checkpoint()
    last = roots(near.where("form is not null").select("word", "form"))
    out = words.join(near, "word", "left").join(last, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
