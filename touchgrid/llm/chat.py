"""Reply trees to training conversations: paths by self-joins, branches ranked, turns templated.

`ancestors` enumerates every root-to-leaf path with iterative self-joins over node ids only,
doubling the reach each round; texts are joined once the paths are chosen. A path becomes one
string of marked turns with a loss mask over the assistant texts. Control strings inside
texts are escaped reversibly, so the output can be read back exactly.

Defined results: null texts and roles count as empty; a parent that is not in its tree makes
the node a root; nodes on a cycle, which no root reaches, give no path; equal scores go to
the longer path, then the smaller leaf; a null score counts as 0; a null tree id is a tree of
its own; rows that repeat a node of a tree are one node (the least by parent, role, text and
score, nulls first), and a node without an id, which nothing can name, is not one; an empty
table gives no conversations. The query orders rows of one conversation
by turn, role and text (nulls first), so that repeated turns are all kept, in a fixed order.
A conversation is one output row, so its own text has to fit into a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchgrid.llm.common import table
from touchgrid.session import cut_lineage

START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"
#: The escapes, in the order in which encoding applies them; decoding goes backwards.
ESCAPES = (("\\", "\\0"), ("<|", "<\\1"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\2"))


def escape(text: Column, pairs=ESCAPES) -> Column:
    """No control string is left inside the text; `unescape` restores it."""
    for plain, coded in pairs:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, pairs=ROLE_ESCAPES) -> Column:
    for plain, coded in reversed(pairs):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def ancestors(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): each leaf with all nodes on its way to the root, `up` steps away.

    Round k joins what is known with the jump pointers over 2^k steps, then the pointers with
    themselves; the number of rounds is the logarithm of the longest path.
    """
    ids = nodes.select("tree", "node", "parent")
    known = ids.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    own = F.col("tree").eqNullSafe(F.col("t"))
    hops = ids.where("parent IS NOT NULL").join(known, own & (F.col("parent") == F.col("p")), "left_semi")
    jumps = cut_lineage(hops.select("tree", "node", F.col("parent").alias("to")))
    parents = jumps.select(F.col("tree").alias("t"), F.col("to").alias("p")).distinct()
    leaves = ids.join(parents, own & (F.col("node") == F.col("p")), "left_anti")
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("up"))
    deepest = nodes.groupBy("tree").count().agg(F.max("count").alias("n")).first()["n"] or 0
    first_jumps, step = jumps, 1
    while step < deepest and not jumps.isEmpty():
        j = jumps.select(F.col("tree").alias("t"), F.col("node").alias("p"), "to")
        further = paths.join(j, own & (F.col("node") == F.col("p"))).select(
            "tree", "leaf", F.col("to").alias("node"), (F.col("up") + step).alias("up")
        )
        paths = cut_lineage(paths.unionByName(further))
        jumps = cut_lineage(
            jumps.join(j.withColumnRenamed("to", "far"), own & (F.col("to") == F.col("p"))).select(
                "tree", "node", F.col("far").alias("to")
            )
        )
        step *= 2
    # A path that ends in a cycle never reaches a root.
    onward = first_jumps.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    rooted = paths.join(onward, own & (F.col("node") == F.col("p")), "left_anti").select(
        F.col("tree").alias("t"), F.col("leaf").alias("l"), F.col("up").alias("depth")
    )
    return paths.join(rooted, own & (F.col("leaf") == F.col("l"))).select("tree", "leaf", "node", "up", "depth")


def choose_branches(paths: DataFrame, nodes: DataFrame, branches: int) -> DataFrame:
    """The nodes of the `branches` best paths of each tree by mean score, with their `rank`."""
    scores = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"), F.coalesce("score", F.lit(0.0)).alias("s"))
    rated = paths.join(scores, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("p")))
    per_leaf = rated.groupBy("tree", "leaf").agg(F.avg("s").alias("score"), F.max("depth").alias("depth"))
    order = W.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "leaf")
    best = per_leaf.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)
    best = best.select(F.col("tree").alias("t"), F.col("leaf").alias("l"), "score", "rank")
    return paths.join(best, F.col("tree").eqNullSafe(F.col("t")) & (F.col("leaf") == F.col("l"))).select(
        "tree", "leaf", "node", (F.col("depth") - F.col("up")).alias("place"), "score", "rank"
    )


def format_trees(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, score, formatted, loss) for nodes (tree, node, parent, role, text, score).

    `loss` lists the (start, length) stretches of `formatted`, in code points from 0, that
    count in training: the assistant texts in their escaped form.
    """
    own = F.min(F.struct("parent", "role", "text", "score")).alias("own")
    nodes = nodes.where("node IS NOT NULL").groupBy("tree", "node").agg(own)
    nodes = cut_lineage(nodes.select("tree", "node", "own.*"))
    chosen = choose_branches(ancestors(nodes), nodes, branches)
    texts = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"), "role", "text")
    turns = chosen.join(texts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("p")))
    turns = turns.select(
        "tree", "leaf", "rank", "score", "place",
        (F.col("role") == TRAINED_ROLE).alias("trained"),
        F.concat(F.lit(START), escape(F.coalesce("role", F.lit("")), ROLE_ESCAPES), F.lit("\n")).alias("head"),
        escape(F.coalesce("text", F.lit(""))).alias("body"),
    )
    turns = turns.withColumn("turn", F.concat("head", "body", F.lit(END)))
    path = W.partitionBy("tree", "leaf", "rank", "score").orderBy("place")
    before = F.coalesce(F.sum(F.char_length("turn")).over(path.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    turns = turns.withColumn("start", before + F.char_length("head"))
    span = F.struct(F.col("start").cast("int").alias("start"), F.char_length("body").alias("length"))
    return turns.groupBy("tree", "leaf", "rank", "score").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("place", "turn"))), lambda x: x["turn"]), ""
        ).alias("formatted"),
        F.sort_array(F.collect_list(F.when(F.col("trained"), span))).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) pairs of a formatted conversation, as they were before escaping."""
    parts = F.filter(F.split(formatted, "<\\|im_end\\|>\n"), lambda x: x != "")

    def turn(part: Column) -> Column:
        body = F.substring(part, F.lit(len(START) + 1), F.char_length(part))
        role = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.char_length(role) + 2, F.char_length(body))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    texts = F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))
    return F.array_join(texts, "")


def linear_nodes(conversations: DataFrame) -> DataFrame:
    """Rows by turn as reply chains: each row answers the one before it."""
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order))
    return placed.select(
        F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"),
    )


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.inline(F.array(*[
            F.struct(F.lit(t).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(probe).alias("text"))
            for t, r in enumerate(("user", "assistant"))
        ])),
    )
    done = format_trees(linear_nodes(rows.unionByName(extra)))
    turns = read_turns(F.col("formatted"))
    joined = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    out = done.select(
        F.col("tree").alias("conv_id"), F.size(turns).cast("long").alias("n_turns"), joined.alias("turns"),
        read_loss(F.col("formatted"), F.col("loss")).alias("trained"), "formatted",
    )
    return out.select(
        "conv_id", "n_turns", F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


QUERIES = {"op7_chat_format": op7_chat_format}
ORACLES = {
    "op7_chat_format": """
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), coded AS (
  SELECT *, length(replace(replace(text, chr(92), chr(92) || '0'), '<|', '<' || chr(92) || '1')) AS coded_text,
         length(replace(replace(replace(role, chr(92), chr(92) || '0'), '<|', '<' || chr(92) || '1'),
                chr(10), chr(92) || '2')) AS coded_role
  FROM given
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(coded_text + coded_role + 12 + 1 + 11)::BIGINT AS formatted_chars
FROM coded GROUP BY conv_id
"""
}
