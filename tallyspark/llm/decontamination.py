"""Benchmark decontamination with DataFrame functions only.

The benchmark's n-grams (13 words; a shorter item is one n-gram) form a small table of distinct
windows with a 64-bit hash each. Texts are read and split once and cut into chunks of words that
overlap by a window. The hash of a window is made from the hashes of its first and its last words, of
8, 4, 2 and 1 words, so each level serves all windows of a chunk and all widths. The hashes of a chunk
meet the benchmark's in a broadcast hash join, and the words of a candidate verify it: only then is a
window built as a string. Of a benchmark beyond `BROADCAST_BYTES` only the hashes are broadcast, and
the candidates that they leave meet the windows in a shuffle; if even the hashes exceed the bound, all
windows are shuffled. The results are the same.

Null and wordless texts have no words and no hits; wordless items give no window; repeated items hit
under each of their ids. Documents are told apart by doc_id and a 128-bit digest of the text: repeated
rows get the same result, different texts of one id, or without an id, each their own. Other columns
of either table are not read, and travel in one column where rows are kept, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 13
CHUNK = 512  # words whose windows stand in memory at a time
BROADCAST_BYTES = 64 << 20
HASH_BYTES = 32  # what one broadcast hash takes at most

#: What separates words, after A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP_OF_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD_AND_GAP = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x60\x7B-\x7F]*"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """The text with A-Z, and no other letter, in lower case; of ASCII alone `lower` makes the same, faster."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    """The normalised words of a text, an empty array for null."""
    parts = F.split(F.coalesce(text, F.lit("")), GAP_OF_ANY_CASE)
    return F.transform(F.filter(parts, lambda w: w != ""), lower_ascii)


def count_words(text: Column) -> Column:
    """Number of words; what stands before a first and after a last gap is none."""
    ends = [F.when(end.rlike(GAP_OF_ANY_CASE), 1).otherwise(0) for end in (F.substring(text, 1, 1), F.substring(text, -1, 1))]
    return F.when(F.length(text) > 0, F.size(F.split(text, GAP_OF_ANY_CASE)) - ends[0] - ends[1]).otherwise(0).cast("long")


def _digest() -> Column:
    """What tells different texts of one id apart."""
    return F.md5(F.coalesce(F.col("text"), F.lit("")))


def _bound(value: Column, use) -> Column:
    """use(value), with the value computed once and not again at every element of a lambda inside."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _windows(tokens: Column, width: Column) -> Column:
    """All windows of `width` words, in order."""

    def cut(bound: Column) -> Column:
        count = F.size(bound) - width + 1
        starts = F.sequence(F.lit(1), F.greatest(count, F.lit(1)))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(bound, i, width), " "))
        return F.when(count > 0, joined).otherwise(F.array().cast("array<string>"))

    return _bound(tokens, cut)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """gram string, width int, items array<string>: distinct windows and the items that hold them."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("tokens"))
    items = items.where(F.size("tokens") > 0)
    items = items.withColumn("width", F.least(F.size("tokens"), F.lit(window)))
    grams = items.select("item", "width", F.explode(_windows(F.col("tokens"), F.col("width"))).alias("gram"))
    return grams.groupBy("gram", "width").agg(F.collect_set("item").alias("items"))


def _window_hashes(tokens: Column, widths: list[int]) -> Column:
    """array<struct<width int, hashes array<long>>>: a hash of each window that fits, in order, by width."""

    def paired(hashes: Column, apart: int) -> Column:
        # Past the end the partner is null; those places are cut off below.
        return F.zip_with(hashes, F.slice(hashes, apart + 1, F.size(hashes)), lambda a, b: F.xxhash64(a, b))

    def fitting(hashes: Column, width: int, size: int) -> Column:
        whole = hashes if width == size else paired(hashes, width - size)
        return F.slice(whole, 1, F.greatest(F.size(hashes) - (width - 1), F.lit(0)))

    def level(hashes: Column, size: int) -> Column:
        """The structs of all widths from `size` words on, given the hashes of `size` words."""
        here = [w for w in widths if size <= w < 2 * size]
        rows = [F.struct(F.lit(w).alias("width"), fitting(hashes, w, size).alias("hashes")) for w in here]
        if not any(w >= 2 * size for w in widths):
            return F.array(*rows)
        wider = _bound(paired(hashes, size), lambda bound: level(bound, 2 * size))
        return F.concat(F.array(*rows), wider) if rows else wider

    return _bound(F.transform(tokens, lambda word: F.xxhash64(word)), lambda bound: level(bound, 1))


def _hashed(windows: DataFrame, widths: list[int]) -> DataFrame:
    """The windows with `hash`, that of their words."""
    own = F.filter(_window_hashes(F.split("gram", " "), widths), lambda x: x["width"] == F.col("width"))
    return windows.withColumn("hash", own[0]["hashes"][0])


def _widths_and_sizes(windows: DataFrame) -> tuple[list[int], int, int]:
    """Widths, bytes and number of the windows."""
    size = F.sum(F.length("gram") * 4 + F.size("items") * 32 + 64)
    rows = windows.groupBy("width").agg(size.alias("size"), F.count(F.lit(1)).alias("n")).collect()  # at most `window`
    return sorted(r["width"] for r in rows), sum(r["size"] for r in rows), sum(r["n"] for r in rows)


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, digest, start long, width int, items: every place of a text where a benchmark window stands."""
    windows = benchmark_windows(benchmark, window)
    widths, size, count = _widths_and_sizes(windows)
    widths = widths or [window]
    windows = _hashed(windows, widths)

    def chunked(bound: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(bound) - 1, F.lit(0)), F.lit(CHUNK))
        part = F.lit(CHUNK + window - 1)
        return F.transform(starts, lambda s: F.struct(s.alias("base"), F.slice(bound, s + 1, part).alias("part")))

    chunks = docs.select("doc_id", _digest().alias("digest"), F.explode(_bound(words(F.col("text")), chunked)).alias("c"))
    chunks = chunks.select("doc_id", "digest", "c.base", "c.part", F.explode(_window_hashes(F.col("c.part"), widths)).alias("h"))
    # A window belongs to the chunk that it starts in, so the overlap is not searched twice.
    own = F.slice("h.hashes", 1, CHUNK)
    places = chunks.select("doc_id", "digest", "base", "part", F.col("h.width").alias("width"), F.posexplode(own).alias("place", "hash"))
    start = (F.col("base") + F.col("place")).cast("long").alias("start")
    if size <= BROADCAST_BYTES:
        met = places.drop("width").join(F.broadcast(windows), "hash")
        # Not written as an equality, which would become a key of the join, built for every window.
        here = F.concat(F.array_join(F.slice("part", F.col("place") + 1, F.col("width")), " "), F.lit(" "))
        met = met.where(here.startswith(F.concat("gram", F.lit(" "))))
        return met.select("doc_id", "digest", start, "width", "items")
    if count * HASH_BYTES <= BROADCAST_BYTES:
        places = places.join(F.broadcast(windows.select("hash")), "hash", "left_semi")
    gram = F.array_join(F.slice("part", F.col("place") + 1, F.col("width")), " ").alias("gram")
    met = places.select("doc_id", "digest", start, "width", gram).join(windows, ["gram", "width"])
    return met.select("doc_id", "digest", "start", "width", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: digest, n_words, n_hit, item_ids (sorted strings), spans of hit words, contaminated.

    A document is contaminated if a word is hit and at least a twentieth of its words are.
    """
    sizes = docs.select("doc_id", _digest().alias("digest"), count_words(F.col("text")).alias("n_words"))
    covered = (
        hits(docs, benchmark, window)
        .select(
            "doc_id",
            "digest",
            F.sequence("start", F.col("start") + F.col("width") - 1).alias("covers"),
            "items",
        )
        .groupBy("doc_id", "digest")
        .agg(
            F.array_distinct(F.flatten(F.collect_set("covers"))).alias("hit_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"),
        )
    )
    covered = covered.withColumnsRenamed({"doc_id": "__doc", "digest": "__digest"})
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("digest") == F.col("__digest"))
    out = sizes.join(covered, same, "left").select(
        "doc_id",
        "digest",
        "n_words",
        F.when(F.col("hit_words").isNull(), 0).otherwise(F.size("hit_words")).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("hit_words", F.array().cast("array<bigint>")).alias("hit_words"),
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW) -> DataFrame:
    """The documents without those that are contaminated, or (`remove="spans"`) without the words hit.

    With "spans", a hit word goes with the characters up to the next word; columns stay as they are.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    judged = contamination(docs, benchmark, window)
    bad = judged.where("contaminated" if remove == "documents" else "n_hit > 0")
    bad = bad.groupBy(F.col("doc_id").alias("bad_id"), F.col("digest").alias("bad_digest")).agg(F.first("hit_words").alias("hit"))
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    rows = docs.select("doc_id", "text", _digest().alias("digest"), whole)
    same = F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("digest") == F.col("bad_digest"))
    if remove == "documents":
        return rows.join(bad, same, "left_anti").select("row.*")
    met = rows.join(bad, same, "left")
    pieces = F.regexp_extract_all(F.col("text"), F.lit(WORD_AND_GAP), F.lit(0))
    places = F.transform(pieces, lambda p, i: F.struct(i.cast("long").alias("i"), p.alias("p")))
    hit = F.map_from_arrays(F.col("hit"), F.transform("hit", lambda _: F.lit(True)))
    kept = F.array_join(F.transform(F.filter(places, lambda x: ~F.map_contains_key(hit, x["i"])), lambda x: x["p"]), "")
    head = F.regexp_extract(F.col("text"), r"^" + GAP, 0)
    text = F.when(F.col("hit").isNull(), F.col("text")).otherwise(F.concat(head, kept))
    return met.withColumn("row", F.col("row").withField("text", text)).select("row.*")
