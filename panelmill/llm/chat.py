"""Chat formatting in Spark expressions: a template with reversible escapes, a loss mask, and its reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of the template. All begin with ``<|``, which escaped texts never contain.
START, END, NEXT = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>"


def escaped(text: Column) -> Column:
    r"""Backslashes doubled, then ``<|`` as ``<\|``: only an escape has a single backslash between the two."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\n|"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<\\n|"), F.lit("\n")))


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans, n_merged`` for each conversation of ``turns(conv_id, turn, role, text, ...)``.

    Turns go by turn, then role and text, so that ties and repeated rows have one order; null turns come first. A null
    text or role counts as empty. Adjacent turns of one role become one block ``<|im_start|>role\\ntext<|im_sep|>text
    <|im_end|>``; n_merged counts the blocks. loss_spans has (begin, length) in code points of ``formatted`` of every text
    of ``loss_role``. No rows, no conversations; a null conv_id is a conversation of its own; other columns are ignored.
    A conversation becomes one string, so its turns meet in one task: that is the result's own size, 2 GB at most.
    """
    rows = turns.select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t")
    )
    sorted_ = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    first = F.filter(
        F.transform("t", lambda _, i: i),
        lambda i: (i == 0) | (F.get("t", i - 1)["role"] != F.get("t", i)["role"]),
    )
    runs = sorted_.withColumn("first", first)
    block = F.transform(
        "first",
        lambda at, k: F.struct(
            F.get("t", at)["role"].alias("role"),
            F.transform(
                F.slice("t", at + 1, F.coalesce(F.get("first", k + 1), F.size("t")) - at), lambda t: escaped(t["text"])
            ).alias("texts"),
        ),
    )
    merged = runs.select("conv_id", block.alias("blocks"))
    # pieces alternate: what comes before a text, and the text
    pieces = F.flatten(
        F.transform(
            "blocks",
            lambda b, k: F.transform(
                b["texts"],
                lambda text, i: F.struct(
                    F.when(i > 0, F.lit(NEXT)).otherwise(
                        F.concat(F.when(k > 0, F.lit(END)).otherwise(F.lit("")), F.lit(START), _escaped_role(b["role"]), F.lit("\n"))
                    ).alias("lead"),
                    text.alias("text"),
                    (b["role"] == loss_role).alias("loss"),
                ),
            ),
        )
    )
    out = merged.select("conv_id", F.size("blocks").alias("n_merged"), pieces.alias("pieces"))
    # where texts begin: sums over stretches of about the root of the number of pieces, then over the rest of a stretch
    out = out.withColumn("sizes", F.transform("pieces", lambda p: F.length(p["lead"]) + F.length(p["text"])))
    out = out.withColumn("step", F.ceil(F.sqrt(F.size("sizes"))).cast("int"))
    stretches = F.sequence(F.lit(0), F.floor((F.size("sizes") - 1) / F.col("step")).cast("int"))
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda n, x: n + x)
    out = out.withColumn("sums", F.transform(stretches, lambda k: total(F.slice("sizes", k * F.col("step") + 1, F.col("step")))))
    out = out.withColumn("before", F.transform(stretches, lambda k: total(F.slice("sums", F.lit(1), k))))

    def begin(p: Column, i: Column) -> Column:
        own = i % F.col("step")
        return F.get("before", F.floor(i / F.col("step")).cast("int")) + total(F.slice("sizes", i - own + 1, own)) + F.length(p["lead"])

    spans = F.filter(
        F.transform("pieces", lambda p, i: F.struct(begin(p, i).alias("begin"), F.length(p["text"]).alias("length"), p["loss"].alias("loss"))),
        lambda s: s["loss"],
    )
    return out.select(
        "conv_id",
        F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["lead"], p["text"])), ""), F.lit(END)).alias("formatted"),
        F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), s["length"].alias("length"))).alias("loss_spans"),
        "n_merged",
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) structs that a formatted conversation was made of."""
    blocks = F.filter(F.split(formatted, "\\Q" + END + "\\E", -1), lambda b: F.length(b) > 0)

    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role = _unescaped_role(F.substring(head, len(START) + 1, 2**31 - 1))
        body = F.substr(block, F.length(head) + 2)
        return F.transform(F.split(body, "\\Q" + NEXT + "\\E", -1), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, without escapes."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, s["begin"] + 1, s["length"]))), "")
