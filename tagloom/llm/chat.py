"""Chat formatting in budgeted windows.

Prefix sums of the turns' tokens cut a conversation into spans of whole turns. The sums are laid over
a grid of the budget: turns within one cell form a span, a turn that lies across a border is a
span of its own, so that no span is over budget unless it is one turn. Each window has the system
turn, a limited number of turns before the span again, and the span. Only assistant turns of the
span are under the loss mask; what is repeated is masked.

Each turn is `<|turn|>role`, a line end, the text and `<|end|>`; repeated ones begin with
`<|repeat|>`. Control strings within roles and texts, also those of other common templates, are
broken by a backslash after their first character, and backslashes are doubled.

All of it is DataFrame expressions.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagloom.session import Scratch

BUDGET = 512
HISTORY_TURNS = 2
HISTORY_TOKENS = 128
TURN, REPEAT, END = "<|turn|>", "<|repeat|>", "<|end|>"
# What a turn's marks count in tokens.
TURN_TOKENS = 4
_TOKEN = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\x20\x09-\x0D]"
_CONTROL = r"(<)(\||/?s>)|(\[)(/?INST\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1$3\\$2$4")


def unescaped(text: Column) -> Column:
    """A backslash goes; of two, the second stays."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _turns(rows: DataFrame) -> DataFrame:
    """Turns with their place, tokens, and the sums of tokens before and up to them."""
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumns({
        "pos": F.row_number().over(ordered),
        "tokens": F.regexp_count("text", F.lit(_TOKEN)) + TURN_TOKENS})
    placed = Window.partitionBy("conv_id").orderBy("pos")
    rows = rows.withColumn("system", (F.col("pos") == 1) & (F.col("role") == "system"))
    upto = F.sum(F.when(F.col("system"), 0).otherwise(F.col("tokens"))).over(
        placed.rowsBetween(Window.unboundedPreceding, 0))
    first = F.first(F.when(F.col("system"), F.struct("role", "text", "tokens"))).over(
        placed.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumns({"upto": upto, "system_turn": first}).withColumn(
        "before", F.col("upto") - F.when(F.col("system"), 0).otherwise(F.col("tokens")))


def _spans(turns: DataFrame, budget: int, history_turns: int, history_tokens: int) -> DataFrame:
    """Turns with the number of their span, and those of later spans that repeat them."""
    taken = F.coalesce(F.col("system_turn")["tokens"], F.lit(0)) + history_tokens
    cell = F.greatest(F.lit(budget) - taken, F.lit(budget // 4))
    begin, end = F.floor(F.col("before") / cell), F.floor((F.col("upto") - 1) / cell)
    spans = turns.withColumn("span", F.when(F.col("system"), 0).when(begin == end, 2 * begin)
                             .otherwise(2 * begin + 1))
    placed = Window.partitionBy("conv_id").orderBy("pos")
    spans = spans.withColumn("opens", F.coalesce(
        F.col("span") != F.lag("span").over(placed), F.lit(True)))
    later = F.collect_list(F.struct("opens", "span", "before")).over(
        placed.rowsBetween(1, history_turns))
    near = F.filter(later, lambda x: x["opens"] & (
        x["before"] - F.col("before") <= history_tokens))
    return spans.withColumn("again", F.when(F.col("system"), F.array().cast("array<bigint>")).otherwise(
        F.transform(near, lambda x: x["span"])))


def formatted(rows: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
              history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """`conv_id`, `window`, `text`, `tokens` and `loss`, an array of (start, length) in code points.

    `rows` has `conv_id`, `turn`, `role`, `text`; NULL roles and texts are empty, rows with a NULL
    conv_id are one conversation, NULL turns come first. Equal turns are ordered by role and text,
    and repeated rows are kept. Only a first turn can be the system turn. Windows are numbered
    upwards, with gaps. An empty table gives no rows; other columns are not looked at.
    """
    plain = rows.select(F.col("conv_id").cast("long").alias("conv_id"),
                        F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    spans = _spans(_turns(plain), budget, history_turns, history_tokens)
    places = F.explode(F.concat(F.array(F.struct(F.col("span").alias("window"),
                                                 F.lit(False).alias("repeat"))),
                                F.transform("again", lambda span: F.struct(
                                    span.alias("window"), F.lit(True).alias("repeat")))))
    turn = F.struct("pos", "place.repeat", "role", "text", "tokens")
    windows = (spans.withColumn("place", places).groupBy("conv_id", "place.window")
               .agg(F.array_sort(F.collect_list(turn)).alias("turns"),
                    F.max(F.when(F.col("place.window") > 0, F.col("system_turn"))).alias("system_turn")))
    # The system turn is in its own window anyway.
    system = F.when(F.col("system_turn").isNotNull(), F.array(F.struct(
        F.lit(0).alias("pos"), F.lit(True).alias("repeat"), F.col("system_turn")["role"].alias("role"),
        F.col("system_turn")["text"].alias("text"),
        F.col("system_turn")["tokens"].cast("int").alias("tokens"))))
    own_system = F.exists("turns", lambda t: (t["pos"] == 1) & ~t["repeat"])
    turns = F.when(own_system | system.isNull(), F.col("turns")).otherwise(
        F.concat(system, F.col("turns")))

    def head(turn):
        return F.concat(F.when(turn["repeat"], REPEAT).otherwise(TURN), escaped(turn["role"]),
                        F.lit("\n"))

    parts = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), escaped(t["text"]).alias("text"),
        ((t["role"] == "assistant") & ~t["repeat"]).alias("target")))
    windows = (windows.withColumn("turns", turns)
               .withColumn("tokens", F.aggregate("turns", F.lit(0), lambda n, t: n + t["tokens"]))
               .withColumn("parts", parts).drop("turns", "system_turn"))
    sizes = F.transform("parts", lambda p: F.length(p["head"]) + F.length(p["text"]) + len(END))
    windows = windows.withColumn("sizes", sizes)
    starts = F.transform("parts", lambda p, i: F.struct(
        (F.aggregate(F.slice("sizes", 1, i), F.lit(0), lambda n, size: n + size)
         + F.length(p["head"])).alias("start"), F.length(p["text"]).alias("length"), p["target"]
        .alias("target")))
    loss = F.transform(F.filter(starts, lambda s: s["target"]),
                       lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["text"], F.lit(END))), "")
    return windows.select("conv_id", "window", text.alias("text"), "tokens", loss.alias("loss"))


def read_back(windows: DataFrame) -> DataFrame:
    """`conv_id`, `n_turns`, `turns_sha256`, `loss_chars`, `loss_sha256`, `formatted_chars`, from the
    windows' texts and masks alone."""
    # Control strings are marks only, so texts can be split at them.
    fresh = F.filter(F.split("text", r"<\|end\|>", -1), lambda part: part.startswith(TURN))
    turns = F.transform(fresh, lambda part: F.concat(
        unescaped(F.substr(part, F.lit(len(TURN) + 1))), F.lit("\n")))
    targets = F.transform("loss", lambda span: unescaped(
        F.substr(F.col("text"), span["start"] + 1, span["length"])))
    parsed = windows.select("conv_id", "window", turns.alias("turns"), targets.alias("targets"),
                            F.length("text").cast("long").alias("chars"))
    whole = parsed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "targets"))).alias("w"),
        F.sum("chars").alias("formatted_chars"))
    spoken = F.flatten(F.transform("w", lambda x: x["turns"]))
    learned = F.array_join(F.flatten(F.transform("w", lambda x: x["targets"])), "")
    whole = whole.select("conv_id", "formatted_chars", spoken.alias("spoken"), learned.alias("learned"))
    return whole.select(
        "conv_id", F.size("spoken").cast("long").alias("n_turns"),
        F.sha2(F.array_join("spoken", "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def round_trip(rows: DataFrame) -> DataFrame:
    """Write the windows of all conversations to the shared folder, and read them back."""
    scratch = Scratch(rows.sparkSession, "chat")
    return read_back(scratch.save(formatted(rows), "windows"))
