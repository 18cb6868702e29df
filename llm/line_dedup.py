"""Line deduplication: fuzzy lines by MinHash, exact Jaccard verification and union-find.

Equal lines are one line from the start. A line's signature is the lowest hash of its character
shingles in each bin of the hash space; bands of the signature are the tiles in which
lines meet. Each line of a tile is compared with the tile's lowest, then, while the tile still holds
several components, with members of its largest. Tiles that are not of one piece after that are
gone through pair by pair across components, by pairs of blocks.
Of every component the first line, by document and place, is kept.

Everything is SQL functions. Shingles are rows only within the task that holds their line: they are hashed
and reduced to lowest hashes in generated code, and never move. Lines that meet others get a bitmap in the same
way: each distinct shingle flips one bit, so a bit that differs between two lines stands for at least one shingle
that only one of them has. That bounds the similarity of a pair from above; pairs that it rules out are never rows
and never compared by their texts.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import fits_broadcast
from llm.components import connected_components
from presswork.sources.shared import materialize

SHINGLE = 8
# Lines are the same when SHARE * |union| <= PART * |intersection|: a similarity of 0.8 or more.
SHARE, PART = 4, 5
BANDS, ROWS = 8, 4
# Words of 64 bits in the bitmap of a line that meets others, made in parts of some words; powers of two.
WORDS, PART_WORDS = 32, 4
# Rounds in which members of a tile's smaller components are compared with one of its largest.
PROBES = 1
# Members of a tile that meet those of another block, or their own, in one group.
BLOCK = 1024
_WIDTH = 4


def normalised(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(" \t\r\f\x0b")))


def _key_columns() -> list[Column]:
    """_doc and _hash, which tell documents apart by id and text, and _lines."""
    text = F.coalesce("text", F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1))
    return [doc.alias("_doc"), F.xxhash64(text).alias("_hash"), F.split(text, "\n").alias("_lines")]


def _shingle(wide: Column, at: Column) -> Column:
    """Hash of the shingle that begins at a byte of a line in a fixed-width encoding."""
    return F.xxhash64(F.substring(wide, at, F.lit(SHINGLE * _WIDTH)))


def _places(line: Column) -> Column:
    """First bytes, from 1, of the shingles of a line."""
    last = F.greatest(F.length(line) - SHINGLE, F.lit(0)) * _WIDTH + 1
    return F.sequence(F.lit(1), last, F.lit(_WIDTH))


def distinct_lines(documents: DataFrame) -> DataFrame:
    """Every distinct non-blank line: two hashes (h, g), its first place and the line itself."""
    placed = documents.select(*_key_columns()).select("_doc", "_hash", F.posexplode("_lines").alias("_pos", "_line"))
    lines = placed.withColumn("_line", normalised(F.col("_line"))).where(F.col("_line") != "")
    first = F.min(F.struct("_doc", "_hash", "_pos")).alias("first")
    keyed = lines.select(
        F.xxhash64("_line").alias("h"), F.xxhash64(F.lit(1), "_line").alias("g"), "_doc", "_hash", "_pos", "_line"
    )
    return keyed.groupBy("h", "g").agg(first, F.first("_line").alias("line"))


def _shingles(line: str) -> Column:
    """Distinct hashes of the shingles of a line; a short line is one shingle."""
    wide = F.array(F.encode(F.col(line), "UTF-32"))
    each = F.transform(wide, lambda w: F.transform(_places(F.col(line)), lambda i: _shingle(w, i)))
    return F.array_distinct(F.flatten(each))


def _bin(value: Column) -> Column:
    """The bin, from 0, of a hash: bins in their order are hashes in their order."""
    return F.shiftright(value, 59) + BANDS * ROWS // 2


def _band_columns(band: int) -> list[Column]:
    """Lowest hashes of a line's band, from rows of bands."""
    own = F.col("band") == band
    return [F.min(F.when(own, F.col(f"m{i}"))).alias(f"m{band * ROWS + i}") for i in range(ROWS)]


def _lowest_hashes(lines: DataFrame) -> DataFrame:
    """h, first and the lowest hash of each bin as m0, m1 ... (null: none).

    Lines are dealt by (h, g), so both groupings stay within the task.
    """
    line = F.col("line")
    key = ["h", "g", "_doc", "_hash", "_pos"]
    wide = lines.select("h", "g", "first.*", F.encode(line, "UTF-32").alias("wide"), _places(line).alias("places"))
    hashed = wide.select(*key, "wide", F.explode("places").alias("at"))
    hashed = hashed.select(*key, _shingle(F.col("wide"), F.col("at")).alias("x"))
    cut = hashed.select(
        *key,
        "x",
        (F.shiftright("x", 61) + BANDS // 2).alias("band"),
        F.shiftright("x", 59).bitwiseAND(F.lit(ROWS - 1)).alias("row"),
    )
    bands = cut.groupBy("h", "g", "band").agg(
        *(F.min(F.when(F.col("row") == i, F.col("x"))).alias(f"m{i}") for i in range(ROWS)),
        *(F.min(c).alias(c) for c in key[2:]),
    )
    return bands.groupBy("h", "g").agg(
        F.struct(*(F.min(c).alias(c) for c in key[2:])).alias("first"),
        *(c for band in range(BANDS) for c in _band_columns(band)),
    )


def signed_lines(lines: DataFrame) -> DataFrame:
    """h, first and the keys of the bands of every distinct line."""
    n = BANDS * ROWS
    every = F.array(*(F.col(f"m{i}") for i in range(n)))
    # What several expressions read is the one element of an array, so that it is computed once.
    one = F.lit(1).cast("bigint")
    masked = F.transform(
        F.array(F.array_compact(every)),
        lambda m: F.struct(
            m.alias("m"),
            F.aggregate(m, F.lit(0).cast("bigint"), lambda mask, x: mask.bitwiseOR(F.call_function("shiftleft", one, _bin(x).cast("int")))).alias("mask"),
        ),
    )

    # A bin that a short line leaves empty takes the value of the next one that it fills; which that is
    # follows from the number of filled bins below, counted in a bit mask.
    def value(s: Column, i: Column) -> Column:
        below = F.bit_count(s["mask"].bitwiseAND(F.call_function("shiftleft", one, i) - 1))
        return F.coalesce(F.get(s["m"], below), F.get(s["m"], F.lit(0)))

    places = F.sequence(F.lit(0), F.lit(n - 1))
    filled = F.get(F.transform(masked, lambda s: F.transform(places, lambda i: value(s, i))), F.lit(0))
    full = F.lit(True)
    for i in range(n):
        full = full & F.col(f"m{i}").isNotNull()
    signed = _lowest_hashes(lines).select("h", "first", F.when(full, every).otherwise(filled).alias("m"))
    bands = [F.xxhash64(F.lit(i), F.slice("m", i * ROWS + 1, ROWS)) for i in range(BANDS)]
    return signed.select("h", "first", F.array(*bands).alias("bands"))


def _mapped(texts: DataFrame) -> DataFrame:
    """h and line with map, the number of the line's distinct shingles and the words of its bitmap.

    Texts are dealt by h, so both groupings stay within the task; repeated shingles are left out before they are rows.
    """
    cut = texts.select("h", F.explode(_shingles("line")).alias("x")).select(
        "h",
        F.shiftright("x", 6).bitwiseAND(F.lit(PART_WORDS - 1)).alias("word"),
        F.shiftright("x", 16).bitwiseAND(F.lit(WORDS // PART_WORDS - 1)).alias("part"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("x").bitwiseAND(F.lit(63)).cast("int")).alias("bit"),
    )
    parts = cut.groupBy("h", "part").agg(
        *(F.bit_xor(F.when(F.col("word") == i, F.col("bit"))).alias(f"w{i}") for i in range(PART_WORDS)),
        F.count(F.lit(1)).alias("n"),
    )
    whole = parts.groupBy("h").agg(
        F.sum("n").alias("n"),
        *(F.bit_xor(F.when(F.col("part") == i // PART_WORDS, F.col(f"w{i % PART_WORDS}"))).alias(f"w{i}") for i in range(WORDS)),
    )
    words = [F.coalesce(w, F.lit(0).cast("bigint")).alias(w) for w in _word_names()]
    return texts.join(whole.select("h", F.struct("n", *words).alias("map")), "h")


def _word_names() -> list[str]:
    return [f"w{i}" for i in range(WORDS)]


def _may_be_similar(left: str, right: str) -> Column:
    """Whether bitmaps leave room for enough similarity of two lines, given as structs of n and words.

    Of similar sets, what only one has is at most the ninth part of both sizes together.
    """
    apart = F.lit(0)
    for w in _word_names():
        apart = apart + F.bit_count(F.col(f"{left}.{w}").bitwiseXOR(F.col(f"{right}.{w}")))
    return apart * (SHARE + PART) <= (F.col(f"{left}.n") + F.col(f"{right}.n")) * (PART - SHARE)


def _texts_of(documents: DataFrame, lines: DataFrame) -> DataFrame:
    """h and text of lines, given by their first places, read from the documents."""
    wanted = lines.groupBy(F.col("first._doc").alias("_doc"), F.col("first._hash").alias("_hash")).agg(
        F.collect_list(F.struct("h", F.col("first._pos").alias("_pos"))).alias("_wanted")
    )
    wanted = materialize(wanted, "wanted-lines")
    size = F.size("_wanted") * 24 + 64
    side = F.broadcast(wanted) if fits_broadcast(wanted, size) else wanted
    joined = documents.select(*_key_columns()).join(side, ["_doc", "_hash"]).select("_lines", F.inline("_wanted"))
    line = normalised(F.get("_lines", F.col("_pos")))
    # Rows that repeat a document give a line more than once.
    return joined.select("h", line.alias("line")).dropDuplicates(["h"])


def _similar(a: str, b: str) -> Column:
    """Whether the shingle sets of two lines are similar enough."""

    sets = F.struct(_shingles(a).alias("x"), _shingles(b).alias("y"))
    counted = F.transform(
        F.array(sets),
        lambda s: F.struct(
            F.size(F.array_intersect(s["x"], s["y"])).alias("shared"), (F.size(s["x"]) + F.size(s["y"])).alias("both")
        ),
    )
    return F.exists(counted, lambda c: c["shared"] * PART >= (c["both"] - c["shared"]) * SHARE)


def _verify(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Those pairs (a, b) of lines that are similar; texts are compared where bitmaps allow it."""
    left = lines.select(F.col("h").alias("a"), F.col("line").alias("_a"), F.col("map").alias("_x"))
    right = lines.select(F.col("h").alias("b"), F.col("line").alias("_b"), F.col("map").alias("_y"))
    met = pairs.join(left, "a").join(right, "b").where(_may_be_similar("_x", "_y"))
    return met.where(_similar("_a", "_b")).select("a", "b")


def _open_tiles(shared: DataFrame, placed: DataFrame) -> DataFrame:
    """Members (key, h, component) of the tiles that hold several components, with the largest one, _main, and their number, _n."""
    named = placed.withColumnRenamed("node", "h")
    members = shared.select("key", "h").join(named, "h", "left").withColumn("component", F.coalesce("component", "h"))
    mixed = members.groupBy("key").agg(
        F.min("component").alias("_low"),
        F.max("component").alias("_high"),
        F.bit_xor(F.xxhash64("h")).alias("_x"),
        F.bit_xor(F.xxhash64(F.lit(3), "h")).alias("_y"),
        F.count(F.lit(1)).alias("_n"),
    )
    # Tiles with the same members are gone through once.
    tiles = mixed.where(F.col("_low") != F.col("_high")).groupBy("_x", "_y", "_n").agg(F.min("key").alias("key"))
    open_members = members.join(tiles.select("key", "_n"), "key")
    sizes = open_members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("_size"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("_size", "component"))["component"].alias("_main"))
    return materialize(open_members.join(largest, "key"), "open-tiles")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _probes(seated: DataFrame, number: int) -> DataFrame:
    """Pairs of every member outside a tile's largest component with one member of that, another each time."""
    draw = F.min(F.struct(F.xxhash64(F.lit(number), "h"), "h"))["h"].alias("_probe")
    probe = seated.where(F.col("component") == F.col("_main")).groupBy("key").agg(draw)
    others = seated.where(F.col("component") != F.col("_main")).join(probe, "key")
    return others.select(*_pair("h", "_probe")).distinct()


def _across_components(seated: DataFrame, lines: DataFrame) -> DataFrame:
    """Pairs of lines of different components in the same tile that bitmaps do not rule out.

    A member meets the blocks of its tile one by one; a group holds at most about BLOCK members of each side,
    and pairs that are ruled out are never rows.
    """
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("h"), blocks).cast("int")
    members = seated.join(lines.select("h", "map"), "h").select("key", "h", "component", "_main", "map", blocks.alias("_blocks"), own.alias("_own"))
    every = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    one = members.where(F.col("component") != F.col("_main")).select(
        "key", F.col("_own").alias("_i"), every.alias("_j"), F.col("h").alias("a"), F.col("component").alias("_c"), F.col("map").alias("_x")
    )
    other = members.select("key", every.alias("_i"), F.col("_own").alias("_j"), F.col("h").alias("b"), F.col("component").alias("_d"), F.col("map").alias("_y"))
    met = one.hint("merge").join(other, ["key", "_i", "_j"]).where((F.col("_c") != F.col("_d")) & _may_be_similar("_x", "_y"))
    return met.select(*_pair("a", "b")).distinct()


def _as_links(placed: DataFrame) -> DataFrame:
    return placed.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _shared_tiles(seats: DataFrame) -> DataFrame:
    """The seats (key, h) of tiles that several lines share, with the tile's lowest line, c. Tiles are cut by one sort."""
    tile = Window.partitionBy("key")
    ends = seats.select("key", "h", F.min("h").over(tile).alias("c"), F.max("h").over(tile).alias("_high"))
    return ends.where(F.col("c") != F.col("_high")).select("key", "h", "c")


def line_components(documents: DataFrame, signed: DataFrame) -> DataFrame:
    """node and component of the lines, by hash, that are similar to others."""
    shared = materialize(_shared_tiles(signed.select("h", F.explode("bands").alias("key"))), "line-tiles")
    met = materialize(shared.select("h").distinct(), "met-lines")
    chosen = signed.join(met, "h", "left_semi")
    lines = materialize(_mapped(_texts_of(documents, chosen.select("h", "first"))), "lines")
    pairs = materialize(shared.where(F.col("h") != F.col("c")).select(*_pair("c", "h")).distinct(), "probes")
    placed = None
    tried = pairs
    for number in range(PROBES + 1):
        found = _verify(pairs, lines)
        # Components that are known stand for the links that they came from.
        links = found if placed is None else found.unionAll(_as_links(placed))
        placed = materialize(connected_components(links), "line-components")
        seated = _open_tiles(shared, placed)
        if number < PROBES:
            pairs = materialize(_probes(seated, number).join(tried, ["a", "b"], "left_anti"), "probes")
            tried = tried.unionAll(pairs)
    rest = materialize(_across_components(seated, lines).join(tried, ["a", "b"], "left_anti"), "near-lines")
    return connected_components(_verify(rest, lines).unionAll(_as_links(placed)))


def kept_lines(documents: DataFrame) -> DataFrame:
    """_doc, _hash and the places, in order, of the lines that each document keeps."""
    signed = materialize(signed_lines(distinct_lines(documents)), "signed-lines")
    placed = line_components(documents, signed).withColumnRenamed("node", "h")
    grouped = signed.select("h", "first").join(placed, "h", "left")
    alone = grouped.where(F.col("component").isNull()).select("first")
    first = grouped.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("first").alias("first"))
    keepers = alone.unionAll(first.select("first")).select("first.*")
    return keepers.groupBy("_doc", "_hash").agg(F.sort_array(F.collect_list("_pos")).alias("_kept"))


def _reduced(documents: DataFrame) -> DataFrame:
    """_row, the document as it is, with _n_lines, _n_kept and _text, what is left of its text."""
    kept = materialize(kept_lines(documents), "kept-lines")
    side = F.broadcast(kept) if fits_broadcast(kept, F.size("_kept") * 8 + 64) else kept
    rows = documents.select(F.struct(*documents.columns).alias("_row"), *_key_columns())
    joined = rows.join(side, ["_doc", "_hash"], "left")
    places = F.transform("_lines", lambda line, i: F.when(F.btrim(line, F.lit(" \t\r\f\x0b")) == "", i))
    blank = F.filter(places, lambda i: i.isNotNull())
    own = F.coalesce("_kept", F.array().cast("array<int>"))
    stays = F.transform(F.sort_array(F.array_union(own, blank)), lambda i: F.get("_lines", i))
    return joined.select(
        "_row",
        (F.size("_lines") - F.size(blank)).cast("bigint").alias("_n_lines"),
        F.size(own).cast("bigint").alias("_n_kept"),
        F.when(F.col("_row.text").isNotNull(), F.array_join(stays, "\n")).alias("_text"),
    )


def dedup_lines(documents: DataFrame) -> DataFrame:
    """The documents with `text` reduced to the lines that are kept, and the columns n_lines and n_kept.

    Of similar lines, anywhere in the table, the first by doc_id and place is kept. Lines are compared
    in lower case and without surrounding blanks. Blank lines stay and are not counted. A null text stays null; a
    document may end up without any line. Null ids come last; rows with the same id and text
    are one document and keep the same lines. Columns of the input that are named n_lines or n_kept are replaced.
    """
    others = [F.col("_row")[c].alias(c) for c in documents.columns if c not in ("text", "n_lines", "n_kept")]
    counts = [F.col("_n_lines").alias("n_lines"), F.col("_n_kept").alias("n_kept")]
    return _reduced(documents).select(*others, F.col("_text").alias("text"), *counts)


def drop_repeated_lines(documents: DataFrame) -> DataFrame:
    """As dedup_lines with the input's columns only, and without documents that had lines and keep none of them.

    Of every line one place stays this way. A column n_chars is brought up to date."""
    copied = (F.col("_n_lines") > 0) & (F.col("_n_kept") == 0)
    new = {"text": F.col("_text"), "n_chars": F.length("_text")}
    columns = [
        new.get(f.name, F.col("_row")[f.name]).cast(f.dataType).alias(f.name) for f in documents.schema.fields
    ]
    return _reduced(documents).where(~F.coalesce(copied, F.lit(False))).select(*columns)
