"""Document fingerprints as invertible Bloom lookup sketches, in Spark SQL functions only.

A text's paragraphs (lines, long ones cut at sentence ends) become 64-bit digests. A sketch is a table
of cells; each digest enters three of them, adding one to the cell's count and its bits to two XOR
sums. Sketches of two versions subtract cell by cell: what they share cancels, and peeling cells that
hold one digest recovers the digests that differ. A sketch that is too small leaves cells over; the
pair is then tried again with a larger one. The cells of a sketch come in groups of a fixed
size and a digest belongs to one group, so peeling works on small tables however long the texts are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daystrata.sources.files import checkpointed

#: Cells of one group (three tables of eight), and differences per group that a sketch is sized for.
CELLS, LOAD = 24, 10
#: A sketch is made for half of the paragraphs differing; each retry is so many times as large.
GROWTH = (1, 2, 4, 8, 16, 32)
#: Longest paragraph piece in characters.
PIECE = 200

_PIECES = rf"[^\n]{{1,{PIECE}}}(?:[.!?]+|(?=\n|$))|[^\n]{{1,{PIECE}}}"


def let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` standing for ``value``, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def digests(text: str) -> str:
    """SQL: a text's distinct paragraph digests."""
    pieces = f"regexp_extract_all({text}, r'{_PIECES}', 0)"
    return f"array_distinct(transform({pieces}, p -> xxhash64(p)))"


def items(keys: str) -> str:
    """SQL: digests ``k`` with their check bits ``c`` and place bits ``h``."""
    return f"transform({keys}, k -> struct(k, xxhash64(k, 13) as c, xxhash64(k, 7) as h))"


def cells(members: str) -> str:
    """SQL: the cells of one group that ``members`` fill."""
    mine = (
        f"filter({members}, i -> pmod(shiftright(i.h, 20 * (at div {CELLS // 3})), {CELLS // 3}) "
        f"= at % {CELLS // 3})"
    )
    return (
        f"transform(sequence(0, {CELLS - 1}), at -> aggregate({mine}, "
        "struct(0 as n, 0L as k, 0L as c), "
        "(s, i) -> struct(s.n + 1 as n, s.k ^ i.k as k, s.c ^ i.c as c)))"
    )


def subtracted(left: str, right: str) -> str:
    """SQL: one group of a sketch less the same group of another."""
    return (
        f"zip_with({cells(left)}, {cells(right)}, "
        "(x, y) -> struct(x.n - y.n as n, x.k ^ y.k as k, x.c ^ y.c as c))"
    )


def peeled(table: str, most: str) -> str:
    """SQL: how many digests come off a subtracted group; null if cells are left over.

    There are ``most`` digests at most. Each step takes the digest of one cell that holds exactly one, of either side, out of its three
    cells. A group of cells can give up no more digests than it has cells.
    """
    third = CELLS // 3
    out = (
        f"transform(st.t, (x, at) -> if(pmod(shiftright(h, 20 * (at div {third})), {third}) "
        f"= at % {third}, struct(x.n - p.n as n, x.k ^ p.k as k, x.c ^ p.c as c), x))"
    )
    pure = "filter(st.t, x -> abs(x.n) = 1 and x.c = xxhash64(x.k, 13))"
    taken = let("h", "xxhash64(p.k, 7)", f"struct({out} as t, st.d + 1 as d)")
    # The slice has one cell or none, so a step takes one digest out or leaves all as it is.
    step = f"aggregate(slice({pure}, 1, 1), st, (st, p) -> {taken})"
    return (
        f"aggregate(sequence(1, least({CELLS}, greatest({most}, 1))), struct({table} as t, 0 as d), (st, r) -> {step}, "
        "st -> if(exists(st.t, x -> x.n <> 0 or x.k <> 0 or x.c <> 0), null, st.d))"
    )


def difference(a: str, b: str) -> str:
    """SQL: the number of digests in one of two columns of ``items`` only, by sketches of growing size.

    If the largest sketch fails as well, which takes digests that share all their cells, the digests
    themselves are compared.
    """
    start = f"cast(ceil(greatest(1, (size({a}) + size({b})) / {2 * LOAD}.0)) as int)"
    # A group of its own: g of q, the grouping being another one for every size.
    member = "filter({0}, i -> pmod(xxhash64(i.h, q), q) = g)"
    group = let(
        "u", member.format(a),
        let("v", member.format(b), peeled(subtracted("u", "v"), "size(u) + size(v)")),
    )
    # After a group that failed the others are not looked at.
    whole = (
        f"aggregate(sequence(0, q - 1), 0, (d, g) -> if(d is null, null, d + {group}))"
    )
    sizes = ", ".join(str(m) for m in GROWTH)
    tried = (
        f"aggregate(transform(array({sizes}), m -> m * {start}), cast(null as int), "
        f"(found, q) -> coalesce(found, {whole}))"
    )
    exact = f"size(array_except({a}, {b})) + size(array_except({b}, {a}))"
    return f"coalesce({tried}, {exact})"


def fingerprint(a: str) -> str:
    """SQL: paragraph count and the one-group sketch as text, equal for equal texts."""
    shown = "concat(lpad(hex(x.n), 4, '0'), lpad(hex(x.k), 16, '0'))"
    return f"concat(lpad(hex(size({a})), 8, '0'), array_join(transform({cells(a)}, x -> {shown}), ''))"


def _neighbours(keyed: DataFrame) -> DataFrame:
    """``(id, key, n_chars, next_id, next_key)``: the next text by descending id, ties by key, nulls last;
    after the last comes the first. Rows alike in id and text are one.

    Sorted in ranges, a range per task; only the ranges' first rows, one per task, meet in one.
    """
    order = [F.col("id").desc_nulls_last(), F.col("key")]
    ids = keyed.select("id", "key", F.length("text").alias("n_chars")).distinct()
    ranged = checkpointed(
        ids.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    )
    within = Window.partitionBy("range").orderBy(*order)
    here = F.struct("id", "key")
    ahead = ranged.withColumn("ahead", F.lead(here).over(within)).withColumn(
        "place", F.row_number().over(within)
    )
    ahead = ahead.withColumn("first", F.when(F.col("place") == 1, here))
    firsts = checkpointed(ahead.where("place = 1").select(F.col("range").alias("r"), "first"))
    along = Window.orderBy("r")
    all_rows = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    later = firsts.select(
        F.col("r").alias("range"),
        F.coalesce(F.lead("first").over(along), F.first("first").over(all_rows)).alias("later"),
    )
    # One row per range, of which there are as many as shuffle partitions.
    known = ahead.join(F.broadcast(later), "range").withColumn("next", F.coalesce("ahead", "later"))
    return known.select(
        "id", "key", "n_chars", F.col("next.id").alias("next_id"), F.col("next.key").alias("next_key")
    )


def edited_pairs(docs: DataFrame) -> DataFrame:
    """The fingerprints of every row and of its edited text, and how alike they are.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``. The
    edited text has the last third (rounded down) of its code points replaced by the first as many of
    the next text. Null text counts as empty; two empty texts are alike (1.0); a single text is its
    own next; rows alike in id and text get the same answer, each its own row; paragraphs count once
    however often they occur, in any order; an empty table gives no rows; other columns are ignored.
    Work per pair grows with the text and, slowly, with the square of its paragraphs (groups times
    paragraphs); up to some MB a text that is not felt.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("bigint")
    keyed = docs.select(doc_id.alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    # Both joins below read one exchange of the texts.
    filled = keyed.withColumn("id_key", F.coalesce("id", F.lit(-(1 << 63))))
    near = _neighbours(keyed).withColumns(
        {
            "id_key": F.coalesce("id", F.lit(-(1 << 63))),
            "next_id_key": F.coalesce("next_id", F.lit(-(1 << 63))),
        }
    )
    wanted = near.select(
        F.col("id_key").alias("to_id"),
        F.col("key").alias("to_key"),
        F.expr("n_chars div 3").alias("take"),
        F.col("next_id_key").alias("id_key"),
        F.col("next_key").alias("key"),
    )
    texts = filled.select("id_key", "key", "text")
    brought = texts.join(wanted, ["id_key", "key"]).select(
        F.col("to_id").alias("id_key"),
        F.col("to_key").alias("key"),
        F.expr("substring(text, 1, cast(take as int))").alias("start"),
        F.expr(digests("text")).alias("c"),
    )
    # A repeated row brings its start twice.
    brought = brought.dropDuplicates(["id_key", "key"])
    paired = texts.join(brought, ["id_key", "key"]).withColumn("n_chars", F.length("text"))
    paired = paired.withColumn(
        "edited",
        F.expr("concat(substring(text, 1, cast(n_chars - n_chars div 3 as int)), start)"),
    )
    listed = paired.select(
        F.when(F.col("id_key") != -(1 << 63), F.col("id_key")).alias("doc_id"),
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.expr(items(digests("text"))).alias("a"),
        F.expr(items(digests("edited"))).alias("b"),
        F.expr(items("c")).alias("c"),
    )
    found = listed.select(
        "doc_id", "n_chars", "edited_sha256",
        F.expr(fingerprint("a")).alias("fingerprint"),
        F.expr(fingerprint("b")).alias("edited_fingerprint"),
        *[F.expr(f"size({name})").alias(f"n_{name}") for name in "abc"],
        F.expr(difference("a", "b")).alias("d_edited"),
        F.expr(difference("a", "c")).alias("d_next"),
    )
    # Shared paragraphs over all; two empty texts are alike.
    alike = "if(n_a + {0} = 0, 1d, (n_a + {0} - {1}) / cast(n_a + {0} + {1} as double))"
    return found.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        F.expr(alike.format("n_b", "d_edited")).alias("near_edited"),
        F.expr(alike.format("n_c", "d_next")).alias("near_next"),
    )
