r"""Chat formatting in windows of a token budget, with DataFrame operations only.

Turn lengths are summed along each conversation. The running sum is cut into strides; turns that lie
inside one stride form a window, and a turn that crosses a border is a window of its own. So every window
starts and ends with a turn, and holds a stride of new tokens at most or a single longer turn. Each window
also retains the system turn that opens the conversation and repeats the turns that fit ``history`` tokens
before it. Repeated turns carry no loss, so each assistant text is a target exactly once.

A turn is written ``<|im_start|>role\ntext<|im_end|>\n``. Inside roles and texts a backslash precedes each
backslash, the bar of ``<|``, and each line break of a role, so control strings occur only where the
template puts them, and removing one backslash before each character restores the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.mixing import word_count

START, END = "<|im_start|>", "<|im_end|>"
BUDGET, HISTORY = 1024, 256
TURN_TOKENS = 4  # of the template around a text


def escape(text: Column) -> Column:
    """Text in which no control string can begin."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    """Role without control strings and with marked line breaks."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    """The text that ``escape`` or ``escape_role`` was given."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _written(turn: Column) -> Column:
    return F.concat(F.lit(START), escape_role(turn["role"]), F.lit("\n"), escape(turn["text"]), F.lit(END + "\n"))


def _loss_spans(turns: Column) -> Column:
    """Start and length, in code points of the formatted text, of every text that carries loss."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        head = F.length(escape_role(turn["role"])) + len(START) + 1
        body = F.length(escape(turn["text"]))
        span = F.struct((state["at"] + head).alias("start"), body.cast("bigint").alias("length"))
        spans = F.when(turn["loss"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + head + body + len(END) + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, add, lambda state: state["spans"])


def chat_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, target: str = "assistant") -> DataFrame:
    """Windows of conversations: ``conv_id``, ``window`` (from 0), ``n_new``, ``n_repeated``, ``n_tokens``, ``formatted``, ``loss_spans``.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are ignored. Null roles and
    texts count as empty. Rows with the same turn number are ordered by role and text, repeated rows are
    turns of their own, and rows without ``conv_id`` form one conversation. A window exceeds ``budget``
    only by a single turn, or by a system turn longer than the budget allows beside a quarter of it.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", word_count("text") + TURN_TOKENS)
    conversation = Window.partitionBy("conv_id")
    order = conversation.orderBy("turn", "role", "text")
    rows = rows.withColumn("seq", F.row_number().over(order)).withColumn("last_seq", F.max("seq").over(conversation))
    opens = (F.col("seq") == 1) & (F.col("role") == "system") & (F.col("last_seq") > 1)
    system = F.first(F.when(opens, F.struct("seq", "role", "text", "tokens"))).over(conversation.orderBy("seq"))
    rows = rows.withColumn("system", system).where(~opens)
    own = F.coalesce(F.col("system.tokens"), F.lit(0))
    rows = rows.withColumn("stride", F.greatest(F.lit(max(1, budget // 4)).cast("long"), budget - history - own))
    running = F.sum("tokens").over(conversation.orderBy("seq"))
    rows = rows.withColumn("end", running).withColumn("start", F.col("end") - F.col("tokens"))
    first, last = F.floor(F.col("start") / F.col("stride")), F.floor((F.col("end") - 1) / F.col("stride"))
    rows = rows.withColumn("cell", 2 * first + (first != last).cast("long"))
    rows = rows.withColumn("window", F.dense_rank().over(conversation.orderBy("cell")) - 1)
    before = conversation.orderBy("start").rangeBetween(-history, -1)
    rows = rows.withColumn("history", F.collect_list(F.struct("seq", "role", "text", "tokens")).over(before))
    windows = rows.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("seq", "role", "text", "tokens"))).alias("new"),
        F.min_by("history", "seq").alias("history"),
        F.first("system").alias("system"),
    )

    def marked(part: Column, loss: bool) -> Column:
        flag = (lambda t: t["role"] == target) if loss else (lambda t: F.lit(False))
        return F.transform(part, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), t["tokens"].alias("tokens"), flag(t).alias("loss")))

    opening = F.when(F.col("system").isNotNull(), F.array("system")).otherwise(F.array().cast("array<struct<seq:int,role:string,text:string,tokens:bigint>>"))
    windows = windows.withColumn("repeated", F.concat(marked(opening, False), marked(F.col("history"), False)))
    windows = windows.withColumn("all", F.concat("repeated", marked(F.col("new"), True)))
    return windows.select(
        "conv_id",
        "window",
        F.size("new").alias("n_new"),
        F.size("repeated").alias("n_repeated"),
        F.aggregate("all", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("n_tokens"),
        F.array_join(F.transform("all", _written), "").alias("formatted"),
        _loss_spans(F.col("all")).alias("loss_spans"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """Each window with ``turns`` (role and text, unescaped, in order) and ``targets`` (texts under the loss mask), read from the formatted text."""
    closing = len(END) + 1
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, 1 << 30)
    head = r"(?s)^((?:[^\\\n]++|\\.)*+)\n"

    def parsed(piece: Column) -> Column:
        body = F.substring(piece, F.lit(1), F.length(piece) - closing)
        role = F.regexp_extract(body, head, 1)
        text = F.substring(body, F.length(role) + 2, F.length(body))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    targets = F.transform("loss_spans", lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return windows.withColumn("turns", F.transform(pieces, parsed)).withColumn("targets", targets)


def conversation_digests(windows: DataFrame) -> DataFrame:
    """For each conversation, from its windows alone: turns, digests of its turns and of its targets, and sizes.

    A digest covers a whole conversation, so the texts of one conversation meet in one row here.
    """
    read = read_windows(windows)
    repeated = F.when(F.col("window") == 0, F.lit(0)).otherwise(F.col("n_repeated"))  # the first window holds the system turn first
    new = F.slice("turns", repeated + 1, F.greatest(F.lit(0), F.size("turns") - repeated))
    parts = read.select(
        "conv_id",
        "window",
        F.size(new).cast("long").alias("n"),
        F.array_join(F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join("targets", "").alias("loss"),
        F.length("formatted").cast("long").alias("size"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("window", "said", "loss"))).alias("parts"), F.sum("size").alias("formatted_chars")
    )
    said, loss = F.array_join("parts.said", ""), F.array_join("parts.loss", "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )
