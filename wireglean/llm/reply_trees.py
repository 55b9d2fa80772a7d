"""Chat formatting of reply trees.

Messages point to the message they answer. Iterative self-joins double the distance of every
message's known ancestor, so that a tree of depth d takes log2(d) rounds and one row a message;
the same joins add up scores and depths. Leaves are ranked within their tree by the score of their
branch, the chosen leaves are expanded to their paths by the kept ancestor tables, and each path
is written as one conversation in a template whose control strings are escaped inside texts.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wireglean.llm.common import Workspace, pick, query, slices, table

# A turn: <|turn|>role LINE_END text<|end|>LINE_END. Inside roles and texts no "<|" is left standing.
OPEN, CLOSE = "<|turn|>", "<|end|>\n"
#: Characters after which the parts of one very long conversation are cut, between turns.
PART_CHARS = 4 << 20


def escape(text: str) -> str:
    """One more backslash into every ``<``, backslashes, ``|``; so no control string remains."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def format_turn(role: str | None, text: str | None) -> tuple[str, str]:
    """(what stands before the text, the escaped text) of a turn; null counts as empty."""
    name = escape((role or "").replace("\\", "\\\\").replace("\n", "\\n"))
    return f"{OPEN}{name}\n", escape(text or "")


def read_turns(part: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of a formatted part."""
    place = 0
    while place < len(part):
        if not part.startswith(OPEN, place):
            raise ValueError("a turn does not begin where it should")
        line = part.index("\n", place)
        end = part.index(CLOSE, line)
        name = re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", unescape(part[place + len(OPEN):line]))
        yield name, unescape(part[line + 1:end])
        place = end + len(CLOSE)


def ancestors(nodes: DataFrame, ws: Workspace) -> tuple[DataFrame, list[DataFrame]]:
    """((node, root, depth, branch score), ancestor tables by doubling distance) of (node, parent, score).

    A parent that does not exist makes its child a root. Nodes on or below a cycle reach no root and
    are left out: a round doubles the distance, so what is unfinished beyond the number of nodes is one.
    """
    score = F.coalesce("score", F.lit(0.0)).alias("branch")
    first = lambda up: [up.alias("up"), F.when(up.isNull(), F.col("node")).alias("root"),
                        F.when(up.isNull(), 0).otherwise(1).cast("long").alias("depth"), score]
    known = nodes.select(F.col("node").alias("parent"), F.col("node").alias("there"))
    # up: the ancestor at the distance reached; branch, depth: scores and steps below it, or up to the root.
    # Nodes without a parent stay out of the join, where they would all meet under one null key.
    answers = nodes.where("parent IS NOT NULL").join(known, "parent", "left").select("node", *first(F.col("there")))
    tops = nodes.where("parent IS NULL").select("node", *first(F.lit(None).cast("long")))
    state = ws.settle(answers.unionByName(tops), "step-0")
    count, jumps, step = state.count(), [], 0
    while (1 << step) <= 2 * count and state.where("up IS NOT NULL").limit(1).count():
        jumps.append(state.where("up IS NOT NULL").select("node", F.col("up").alias("ancestor")))
        above = state.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("root").alias("its_root"),
                             F.col("depth").alias("its_depth"), F.col("branch").alias("its_branch"))
        moved = state.where("up IS NOT NULL").join(above, "up").select(
            "node", F.col("next").alias("up"), F.col("its_root").alias("root"),
            (F.col("depth") + F.col("its_depth")).alias("depth"), (F.col("branch") + F.col("its_branch")).alias("branch"))
        step += 1
        state = ws.settle(state.where("up IS NULL").unionByName(moved), f"step-{step}")
    return state.where("up IS NULL").select("node", "root", "depth", "branch"), jumps


def paths(messages: DataFrame, ws: Workspace, branches: int | None = 1) -> DataFrame:
    """(path, rank, position, node): root-to-leaf paths of (node, parent, score), named by their leaf.

    Of each tree the ``branches`` paths of the highest summed score (equal ones: the longer, then the one
    whose leaf has the smaller id) are taken, or all if None; ranks begin at 1, positions at 0. The best
    of a tree are found by partial ranks before the shuffle. Null scores count as 0.
    """
    nodes = messages.select("node", "parent", F.col("score").cast("double").alias("score"))
    found, jumps = ancestors(nodes, ws)
    answered = nodes.select(F.col("parent").alias("node")).where("node IS NOT NULL").distinct()
    leaves = found.join(answered, "node", "left_anti")
    order = Window.partitionBy("root").orderBy(F.desc("branch"), F.desc("depth"), F.asc("node"))
    if branches is not None:
        leaves = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)
    else:
        leaves = leaves.withColumn("rank", F.row_number().over(order))
    # Each distance is one sum of powers of two, so every ancestor is reached exactly once.
    on = leaves.select(F.col("node").alias("path"), "rank", F.col("depth").alias("length"), "node",
                       F.lit(0).cast("long").alias("above"))
    for step in range(len(jumps) - 1, -1, -1):
        far = on.join(jumps[step], "node", "left")
        here = F.struct(F.col("node").alias("node"), F.col("above").alias("above"))
        there = F.struct(F.col("ancestor").alias("node"), (F.col("above") + F.lit(1 << step)).alias("above"))
        both = F.when(F.col("ancestor").isNull(), F.array(here)).otherwise(F.array(here, there))
        on = far.select("path", "rank", "length", F.explode(both).alias("at")).select(
            "path", "rank", "length", "at.node", "at.above")
    return on.select("path", "rank", (F.col("length") - F.col("above")).alias("position"), "node")


_PIECE = "path long, rank int, position long, role string, text string"


def conversations(messages: DataFrame, branches: int | None = 1, node_column: str = "node",
                  parent_column: str = "parent", role_column: str = "role", text_column: str = "text",
                  score_column: str | None = None, carry: str | None = None) -> DataFrame:
    """(path, rank, part, text, turns, loss_spans, carried column): the chosen paths as formatted conversations.

    ``loss_spans`` are the characters (end exclusive) of assistant texts in the formatted text. A
    conversation is one part unless it is longer than ``PART_CHARS``; then it goes on in parts 1, 2, ..., cut
    between turns. A path's turns stream through a task in order and are never held together.
    Messages without id are left out; of messages with equal ids the smallest row counts. Null
    roles and texts count as empty. An empty table gives no conversations.
    """
    ws = Workspace(messages.sparkSession, "trees")
    extra = [carry] if carry else []
    score = [score_column] if score_column else []
    rows = pick(messages, node_column, parent_column, role_column, text_column, *score, *extra)
    content = ["role", "text", *(["score"] if score else []), *(["carried"] if extra else [])]
    rows = rows.toDF("node", "parent", *content).where("node IS NOT NULL")
    rows = ws.settle(rows.groupBy("node").agg(F.min(F.struct("parent", *content)).alias("row"))
                     .select("node", "row.*"), "messages")
    if not score:
        rows = rows.withColumn("score", F.lit(0.0))
    on = ws.settle(paths(rows, ws, branches), "paths")
    turns = on.join(rows, "node").select("path", "rank", "position", "role", "text", *(["carried"] if extra else []))
    carried = f", carried {dict(rows.dtypes)['carried']}" if extra else ""
    ordered = turns.repartition("path").sortWithinPartitions("path", "position")
    schema = ("path long, rank int, part int, text string, turns long, "
              f"loss_spans array<struct<start:int,end:int>>{carried}")
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, part, texts, size, spans, done, kind = None, 0, [], 0, [], [], None

        def close():
            done.append((*current[:2], part, "".join(texts), len(texts), spans, *current[2:]))

        def batch():
            columns = [pa.array(list(c)) for c in zip(*((r[0], r[1], r[2], r[4]) for r in done))]
            made = [columns[0].cast(pa.int64()), columns[1].cast(pa.int32()), columns[2].cast(pa.int32()),
                    pa.array([r[3] for r in done], pa.string()), columns[3].cast(pa.int64()),
                    pa.array([r[5] for r in done], span)]
            names = ["path", "rank", "part", "text", "turns", "loss_spans"]
            if kind is not None:
                made.append(pa.array([r[6] for r in done], kind))
                names.append("carried")
            return pa.RecordBatch.from_arrays(made, names=names)

        held = 0
        for incoming in batches:
            for piece in slices(incoming, "text"):
                kind = piece.schema.field("carried").type if extra else None
                for path, rank, _, role, text, *own in zip(*(c.to_pylist() for c in piece.columns)):
                    if current is None or current[0] != path or size >= PART_CHARS:
                        if current is not None:
                            close()
                            held += size
                            part = part + 1 if current[0] == path else 0
                        current, texts, size, spans = (path, rank, *own), [], 0, []
                        if held >= PART_CHARS:
                            yield batch()
                            done, held = [], 0
                    head, body = format_turn(role, text)
                    if role == "assistant":
                        spans.append({"start": size + len(head), "end": size + len(head) + len(body)})
                    texts.append(head + body + CLOSE)
                    size += len(texts[-1])
        if current is not None:
            close()
            yield batch()

    made = ordered.mapInArrow(run, schema)
    return made.withColumnRenamed("carried", carry) if carry else made


def previous_turns(rows: DataFrame, group_column: str, order_columns: list[str], ws: Workspace) -> DataFrame:
    """The rows with (node, parent): node numbers them by group and order, parent is the row before in the group.

    A range-partitioned sort, so a group with a third of all rows is spread like any other; ties go
    by the whole row. Only one row a partition (its first and last group and its count) is gathered.
    """
    columns = rows.columns
    keys = [group_column, *order_columns, *[c for c in columns if c not in (group_column, *order_columns)]]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (rows.withColumn("_tie", F.monotonically_increasing_id())
               .repartitionByRange(tasks, *keys, "_tie").sortWithinPartitions(*keys, "_tie").select(*columns))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), "_task int, _row long, _goes_on boolean"])

    def run(batches):
        from pyspark import TaskContext

        task, row, before = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            group = batch.column(columns.index(group_column)).to_pylist()
            goes_on = [r > 0 and g == (group[i - 1] if i else before)
                       for i, (r, g) in enumerate(zip(range(row, row + len(group)), group))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([task] * len(group), pa.int32()),
                 pa.array(range(row, row + len(group)), pa.int64()), pa.array(goes_on, pa.bool_())],
                names=[*columns, "_task", "_row", "_goes_on"])
            if group:
                row, before = row + len(group), group[-1]

    numbered = ws.settle(ordered.mapInArrow(run, schema), "numbered")
    ends = (numbered.groupBy("_task").agg(F.count("*").alias("n"), F.min_by(group_column, "_row").alias("first"),
                                          F.max_by(group_column, "_row").alias("last")).orderBy("_task").collect())
    offsets, total, before = [], 0, None
    for r in ends:
        offsets.append((r["_task"], total, bool(total) and r["first"] == before))
        total, before = total + r["n"], r["last"]
    joined = numbered.join(F.broadcast(rows.sparkSession.createDataFrame(
        offsets, "_task int, _offset long, _joins boolean")), "_task")
    node = F.col("_offset") + F.col("_row")
    goes_on = F.when(F.col("_row") == 0, F.col("_joins")).otherwise(F.col("_goes_on"))
    return joined.select(*columns, node.alias("node"), F.when(goes_on, node - 1).alias("parent"))


def read_back(formatted: DataFrame, id_column: str) -> DataFrame:
    """(id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), parsed from the formatted parts.

    The parts of a conversation stand one behind the other, as ``conversations`` leaves them.
    """
    schema = (f"`{id_column}` {dict(formatted.dtypes)[id_column]}, n_turns long, turns_sha256 string, loss_chars long, "
              "loss_sha256 string, formatted_chars long")
    rows = formatted.select("path", "part", "text", "loss_spans", id_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, own, state, kind = None, None, None, None

        def ended():
            turns, chars, loss, size, length = state
            return pa.RecordBatch.from_arrays(
                [pa.array([own], kind), pa.array([turns], pa.int64()), pa.array([chars.hexdigest()]),
                 pa.array([size], pa.int64()), pa.array([loss.hexdigest()]), pa.array([length], pa.int64())],
                names=[id_column, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            kind = batch.schema.field(id_column).type
            for this, _, text, spans, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if this != path:
                    if state:
                        yield ended()
                    path, own, state = this, conv, [0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                for role, body in read_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                for s in spans:
                    learned = unescape(text[s["start"]:s["end"]])
                    state[2].update(learned.encode("utf-8", "surrogatepass"))
                    state[3] += len(learned)
                state[4] += len(text)
        if state:
            yield ended()

    return rows.mapInArrow(run, schema)


_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
g AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
             CAST(sum(length(text) + length(role) + len(regexp_extract_all(text, '<\\*\|'))) AS BIGINT) AS chars
      FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       chars + n_turns * 17 AS formatted_chars
FROM g
"""


@query("op7_chat", _SQL)
def op7_chat(spark, sf_dir):
    ws = Workspace(spark, "turns")
    rows = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")],
                                  "conv_id long, turn long, role string, text string")
    messages = previous_turns(rows.unionByName(added), "conv_id", ["turn"], ws)
    return read_back(conversations(messages, branches=None, carry="conv_id"), "conv_id")
