"""Merkle manifest of a table: hash trees by sibling-shift self-joins, proofs, and their verification.

Nodes of a level are rows (group, slot number ``idx``, hash). A node of a
binary tree finds its sibling under ``idx XOR 1``; with a wider fan it asks for
the slots at every offset 1..fan-1 of its own run, and one equijoin of the
level with itself answers. Each node then knows the hashes to its left and to
its right; the rows of slot zero emit their parents, which are the next level.
Levels are written to the shared folder, so a lost executor costs one level.

A second walk goes down again: a node's path is its own pair (left, right)
followed by its parent's path. So a leaf meets the whole path in one join with
level 1, an eighth of its rows, and proofs and folds are plain expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersight.llm.common import stored
from ordersight.operators.ranking import numbered

FAN = 8
_STEP = "array<struct<left:binary,right:binary>>"


def digest(*parts: Column) -> Column:
    """SHA-256, as binary, of the concatenated parts."""
    return F.unhex(F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256))


def hex_text(hash_: Column) -> Column:
    return F.lower(F.hex(hash_))


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    return digest(*[field(v) for v in values])


def _texts(hashes: Column) -> Column:
    return F.concat_ws("", F.transform(hashes, hex_text))


def _sibling_slots(idx: Column, fan: int) -> Column:
    """The slot numbers of a node's possible siblings."""
    if fan == 2:
        return F.array(idx.bitwiseXOR(F.lit(1).cast("long")))
    slot = F.pmod(idx, F.lit(fan))
    return F.array(*[idx - slot + F.pmod(slot + shift, F.lit(fan)) for shift in range(1, fan)])


def with_siblings(nodes: DataFrame, fan: int) -> DataFrame:
    """``nodes`` (grp, idx, n, hash, ...) with the joined hashes of their run to the ``left`` and ``right``."""
    asks = nodes.select("grp", "idx", "n", "hash", F.explode(_sibling_slots(F.col("idx"), fan)).alias("sibling"))
    answers = nodes.select(F.col("grp").alias("s_grp"), F.col("idx").alias("s_idx"), F.col("hash").alias("s_hash"))
    # The last run may be short: a slot that is not there needs no join partner.
    met = asks.filter(F.col("sibling") < F.col("n")).join(answers, F.col("grp").eqNullSafe(F.col("s_grp")) & (F.col("sibling") == F.col("s_idx")))
    around = met.groupBy("grp", "idx").agg(F.sort_array(F.collect_list(F.struct("s_idx", "s_hash"))).alias("around"))
    around = around.select(F.col("grp").alias("a_grp"), F.col("idx").alias("a_idx"), "around")
    side = lambda keep: F.aggregate(
        F.filter(F.coalesce("around", F.array().cast("array<struct<s_idx:bigint,s_hash:binary>>")), keep),
        F.lit(b""),
        lambda acc, s: F.concat(acc, s["s_hash"]),
    )
    joined = nodes.join(around, F.col("grp").eqNullSafe(F.col("a_grp")) & (F.col("idx") == F.col("a_idx")), "left")
    return joined.select(
        *nodes.columns,
        side(lambda s: s["s_idx"] < F.col("idx")).alias("left"),
        side(lambda s: s["s_idx"] > F.col("idx")).alias("right"),
    )


def run_hash(left: Column, own: Column, right: Column) -> Column:
    """The parent of a run: SHA-256 over the hashes as hex text; ``left`` and ``right`` are joined binary hashes."""
    return digest(F.concat(hex_text(left), hex_text(own), hex_text(right)))


def parents(level: DataFrame, fan: int) -> DataFrame:
    """The next level: what the rows of slot zero emit; a group's last single node has no parent."""
    first = level.filter((F.col("n") > 1) & (F.pmod("idx", F.lit(fan)) == 0))
    return first.select("grp", F.floor(F.col("idx") / fan).cast("long").alias("idx"), F.ceil(F.col("n") / fan).cast("long").alias("n"), run_hash(F.col("left"), F.col("hash"), F.col("right")).alias("hash"))


def levels(leaves: DataFrame, fan: int = FAN) -> list[DataFrame]:
    """All levels (grp, idx, n, hash, left, right) over ``leaves`` (grp, idx, n, hash, ...), leaves first and with all their columns."""
    out = []
    widest = leaves.agg(F.max("n")).first()[0] or 0
    nodes = leaves
    while widest:
        out.append(stored(with_siblings(nodes, fan), "merkle-level"))
        nodes = parents(out[-1], fan)
        widest = -(-widest // fan) if widest > 1 else 0
    return out


def paths(tree: list[DataFrame], tops: DataFrame, fan: int = FAN) -> DataFrame:
    """Every leaf of ``tree``, with its columns, and top (the group's last hash), root, path.

    ``tops``: grp, root and the path from the group's last node to the root.
    ``path`` lists (left, right) of every level, from the leaf's own to the root's.
    """
    tops = tops.select(F.col("grp").alias("t_grp"), F.col("root").alias("t_root"), F.col("path").alias("t_path"))
    above = None
    for level in reversed(tree):
        ends = level.filter("n = 1").join(tops, F.col("grp").eqNullSafe(F.col("t_grp")))
        kept = [c for c in level.columns if c not in ("left", "right", "n")]
        found = ends.select(*kept, F.col("hash").alias("top"), F.col("t_root").alias("root"), F.col("t_path").alias("path"))
        if above is not None:
            up = above.select(F.col("grp").alias("p_grp"), F.col("idx").alias("p_idx"), F.col("top").alias("p_top"), F.col("root").alias("p_root"), F.col("path").alias("p_path"))
            at = F.col("grp").eqNullSafe(F.col("p_grp")) & (F.floor(F.col("idx") / fan).cast("long") == F.col("p_idx"))
            step = F.array(F.struct(F.col("left").alias("left"), F.col("right").alias("right")))
            lower = level.filter("n > 1").join(up, at)
            found = found.unionByName(lower.select(*kept, F.col("p_top").alias("top"), F.col("p_root").alias("root"), F.concat(step, "p_path").alias("path")))
        above = found
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that follows from the hash ``start`` and the siblings along ``path``."""
    return F.aggregate(path, start, lambda h, step: run_hash(step["left"], h, step["right"]))


def proof_digest(path: Column) -> Column:
    """SHA-256, as hex, of the siblings along ``path`` as hex text."""
    return F.sha2(F.aggregate(path, F.lit(b""), lambda acc, s: F.concat(acc, hex_text(s["left"]).cast("binary"), hex_text(s["right"]).cast("binary"))), 256)


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case, other letters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def manifest(df: DataFrame, id_col: str, group_col: str, fields: Sequence[str], text_col: str, tampered: Column, fan: int = FAN) -> DataFrame:
    """One row per row of ``df``: id_col, leaf, subroot, root, proof_sha256, folded_root, verified; hashes as hex.

    A leaf hashes ``fields``; per ``group_col`` leaves ascend by id into a
    subroot; subroots, ordered by group, lead to the root. Where ``tampered``
    holds, ``folded_root`` starts from the leaf over the text in lower case.
    Null ids and a null group come first. Rows that share an id are ordered by
    their leaf; equal rows take neighbouring slots. A group of one row has its
    leaf as subroot, a table of one group its subroot as root. An empty table
    gives no rows; other columns are not read. A text is hashed whole, where
    it is, and only hashes move; no group is gathered in one task.
    """
    names = {name: F.col(f"`{name}`") for name in fields}
    changed = names | {text_col: lowered(names[text_col])}
    leaves = df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{group_col}`").cast("string").alias("grp"),
        leaf_hash([names[f] for f in fields]).alias("hash"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf_hash([changed[f] for f in fields])).alias("other"),
    )
    leaves = numbered(stored(leaves, "merkle-leaves"), ["id", "hash"], ["grp"], nulls_first=True, number="place", size="n")
    leaves = stored(leaves.select("id", "grp", (F.col("place") - 1).alias("idx"), "n", "hash", F.coalesce("other", "hash").alias("start")), "merkle-placed")
    tree = levels(leaves, fan)
    if not tree:
        return leaves.select(F.col("id").alias(id_col), *[F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], F.lit(True).alias("verified"))

    subroots = tree[0].filter("n = 1").select("grp", "hash")
    for level in tree[1:]:
        subroots = subroots.unionByName(level.filter("n = 1").select("grp", "hash"))
    subroots = numbered(stored(subroots, "merkle-subroots"), ["grp"], nulls_first=True, number="place", size="n")
    subroots = stored(subroots.select("grp", F.lit(0).alias("all"), (F.col("place") - 1).alias("idx"), "n", "hash"), "merkle-subroots")
    upper = levels(subroots.select(F.col("all").alias("grp"), "idx", "n", "hash"), fan)
    root = upper[-1].select("grp", F.col("hash").alias("root"), F.array().cast(_STEP).alias("path"))
    tops = paths(upper, root, fan).select(F.col("idx").alias("u_idx"), "root", "path").join(subroots.select("grp", "idx"), F.col("u_idx") == F.col("idx")).select("grp", "root", "path")

    found = paths(tree, tops, fan)
    return found.select(
        F.col("id").alias(id_col),
        hex_text(F.col("hash")).alias("leaf"),
        hex_text(F.col("top")).alias("subroot"),
        hex_text(F.col("root")).alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        hex_text(folded(F.col("start"), F.col("path"))).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
