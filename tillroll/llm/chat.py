"""Chat formatting of reply trees.

Messages form trees by their parent.  The path from the root to every leaf is
enumerated by iterative self-joins: a table of jumps (node to its ancestor
2^k replies up) is joined with itself to double the distance, and the leaves
are joined with the jumps from the longest down, so a path of n messages
takes about log2(n) joins and exactly its own rows.  Branches are ranked by
score, and each chosen path is formatted as one conversation.  Paths, scores and
the choice work on keys; texts are joined to the chosen paths only.

All steps are DataFrame functions.  The tables of jumps hold keys only and
are written by a reliable checkpoint each; the doubling ends when no message
has an ancestor that far up.

Format of a message: ``<|im_start|>role``, a line break, the text,
``<|im_end|>``, a line break.  Inside roles and texts ``<|`` becomes ``<||``,
so a text can't form a marker, and reading undoes it; in a role also ``%`` and
line breaks are written ``%25`` and ``%0A``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import scratch_root

START, END = "<|im_start|>", "<|im_end|>"
OPEN, ESCAPED = "<|", "<||"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit(OPEN), F.lit(ESCAPED))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit(ESCAPED), F.lit(OPEN))


def escape_role(role: Column) -> Column:
    role = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escape(role)


def unescape_role(role: Column) -> Column:
    role = F.replace(unescape(role), F.lit("%0A"), F.lit("\n"))
    return F.replace(role, F.lit("%25"), F.lit("%"))


def reply_paths(nodes: DataFrame) -> DataFrame:
    """Every message of every root-to-leaf path.

    ``nodes``: ``tree, node, parent`` (null: a root; a pair of tree and node
    occurs once).  Result: ``tree, leaf, node, up`` with ``up`` replies from
    the leaf.  A parent that does not exist makes its replies unreachable, as
    does a circle of parents; messages below those belong to no path.
    """
    scratch_root(nodes.sparkSession)
    links = nodes.select("tree", "node", "parent").checkpoint()
    largest = links.groupBy("tree").count().agg(F.max("count")).first()[0] or 0  # ends the doubling of a circle
    children = links.where("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaves = links.join(children, links["tree"].eqNullSafe(children["t"]) & (links["node"] == children["p"]),
                        "left_anti")
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))

    jumps = [links.where("parent is not null").select("tree", "node", F.col("parent").alias("above"))]
    while 2 ** len(jumps) < largest:
        a, b = jumps[-1].alias("a"), jumps[-1].alias("b")
        twice = (a.join(b, F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.above") == F.col("b.node")))
                 .select("a.tree", "a.node", F.col("b.above").alias("above")).checkpoint())
        if twice.isEmpty():
            break
        jumps.append(twice)
    for k in reversed(range(len(jumps))):
        j = jumps[k].select(F.col("tree").alias("jt"), F.col("node").alias("jn"), "above")
        further = paths.join(j, paths["tree"].eqNullSafe(j["jt"]) & (paths["node"] == j["jn"])).select(
            "tree", "leaf", F.col("above").alias("node"), (F.col("up") + 2 ** k).alias("up"))
        paths = paths.unionByName(further).checkpoint()
    # a path must end at a root of the table
    roots = links.where("parent is null").select(F.col("tree").alias("rt"), F.col("node").alias("rn"))
    whole = paths.join(roots, paths["tree"].eqNullSafe(roots["rt"]) & (paths["node"] == roots["rn"])).select(
        F.col("tree").alias("wt"), F.col("leaf").alias("wl"))
    return paths.join(whole, paths["tree"].eqNullSafe(whole["wt"]) & (paths["leaf"] == whole["wl"]), "left_semi")


def format_trees(nodes: DataFrame, best: int | None = 1, loss_role: str = "assistant") -> DataFrame:
    """Format the ``best`` branches of every tree as one conversation each (None: all of them).

    ``nodes``: ``tree, node, parent, role, text, score``.  A branch scores the
    sum of its messages' scores (null: 0); ties go to the smaller leaf.  A
    null role or text is empty.  Of several rows with the same tree and node one
    counts, the same on every run; a row with a null node is no message, a null
    tree is a tree.  Result: ``tree, leaf, branch`` (1 is best),
    ``score, n_turns, formatted`` and ``loss_runs``: consecutive lengths of
    ``formatted`` in code points with whether they carry loss (the texts of
    ``loss_role``).  An empty table gives no rows; other columns are not read.
    """
    row = F.xxhash64("parent", "score", "role", "text")
    nodes = nodes.where("node is not null").select(
        "tree", "node", "parent", "score", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    keys = (nodes.select("tree", "node", F.struct(row.alias("row"), "parent", F.coalesce("score", F.lit(0.0)).alias("s")).alias("x"))
            .groupBy("tree", "node").agg(F.min("x").alias("x")).select("tree", "node", "x.*").checkpoint())
    paths = reply_paths(keys)

    # the choice, on keys
    points = keys.select(F.col("tree").alias("kt"), F.col("node").alias("kn"), "s", "row")
    scored = paths.join(points, paths["tree"].eqNullSafe(points["kt"]) & (paths["node"] == points["kn"])).select(
        "tree", "leaf", "node", "up", "s", "row")
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    chosen = scored.groupBy("tree", "leaf").agg(F.sum("s").alias("score")).withColumn("branch", F.row_number().over(order))
    if best is not None:
        chosen = chosen.where(F.col("branch") <= best)
    chosen = chosen.select(F.col("tree").alias("ct"), F.col("leaf").alias("cl"), "score", "branch")
    scored = scored.join(chosen, scored["tree"].eqNullSafe(chosen["ct"]) & (scored["leaf"] == chosen["cl"])).select(
        "tree", "leaf", "node", "up", "score", "branch", "row")

    # texts of the chosen paths; equal rows of one message are one entry of the set
    messages = nodes.select(F.col("tree").alias("mt"), F.col("node").alias("mn"), row.alias("mrow"), "role", "text")
    full = scored.join(messages, scored["tree"].eqNullSafe(messages["mt"]) & (scored["node"] == messages["mn"])
                       & (scored["row"] == messages["mrow"]))
    turns = (full.groupBy("tree", "leaf", "branch", "score")
             .agg(F.sort_array(F.collect_set(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns")))
    opened = lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(opened(t), escape(t["text"]), F.lit(END + "\n"))), "")

    def run(size: Column, loss: Column) -> Column:
        return F.struct(size.cast("long").alias("chars"), loss.alias("loss"))

    runs = F.flatten(F.transform("turns", lambda t: F.array(
        run(F.char_length(opened(t)), F.lit(False)),
        run(F.char_length(escape(t["text"])), t["role"] == loss_role),
        run(F.lit(len(END) + 1), F.lit(False)))))
    return turns.select("tree", "leaf", "branch", "score", F.size("turns").cast("long").alias("n_turns"),
                        text.alias("formatted"), runs.alias("loss_runs"))


def read_turns(formatted: Column) -> Column:
    """The messages of a formatted conversation: array of ``role, text, size``,
    read from the markers; ``size`` is the length of the text as formatted."""
    pieces = F.split(F.substr(formatted, F.lit(len(START) + 1)), "\\Q" + START + "\\E", -1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        rest = F.substr(piece, F.char_length(role) + 2)
        body = F.left(rest, F.char_length(rest) - len(END) - 1)
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"),
                        F.char_length(body).cast("long").alias("size"))

    return F.transform(pieces, turn)


def read_loss(turns: Column, loss_runs: Column) -> Column:
    """The texts under the loss mask, one after another.

    ``turns`` as read from the conversation; a run whose length is not that of
    its text is an error.
    """
    def masked(turn: Column, i: Column) -> Column:
        mark = F.get(loss_runs, 3 * i + 1)
        return (F.when(mark["chars"] != turn["size"], F.raise_error(F.lit("loss mask does not fit")))
                .when(mark["loss"], turn["text"]).otherwise(F.lit("")))

    return F.array_join(F.transform(turns, masked), "")


def chains(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Flat conversations as trees without branches: each row replies to the one before.

    Rows of a conversation are ordered by turn, then role and text; nulls come
    first.
    """
    order = Window.partitionBy("tree").orderBy("__turn", "role", "text")
    flat = rows.select(rows[conv_col].alias("tree"), rows[turn_col].alias("__turn"), rows[role_col].alias("role"),
                       rows[text_col].alias("text"))
    return flat.withColumn("node", F.row_number().over(order).cast("long")).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
        F.lit(0.0).alias("score"))
