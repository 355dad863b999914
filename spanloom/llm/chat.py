"""Chat formatting with typed content parts.

A message's content is a list of parts. A visitor turns each part into text of the formatted string: text is escaped,
an image, audio or document becomes a placeholder, in order; what it stands for goes to the attachment list with its
expanded token count. Everything is DataFrame expressions.

Format of a turn: ``<|im_start|>`` role newline content ``<|im_end|>`` newline. No text can forge these: inside a text
``|`` and ``\\`` get a backslash in front, so ``<|`` never stands there, however a text is cut in parts, and taking the
backslashes away restores it. A newline in a role is written ``<|nl|>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>\n", "<|nl|>"
PART = (
    "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)
#: Tokens of an expanded attachment: a patch's side in pixels, tokens a second, tokens a page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\|])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """The content of a plain text message as a list of one part."""
    null = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            text.cast("string").alias("text"),
            *(null.cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))),
        )
    )


def _visit(part: Column) -> Column:
    """A part's kind, the text it becomes, its reference and the tokens it expands to (null for text)."""
    kind = F.lower(F.coalesce(part["kind"], F.lit("text")))
    is_text = kind == "text"
    known = kind.isin("image", "audio", "document")
    side = lambda c: F.ceil(c / F.lit(PATCH))
    tokens = (
        F.when(kind == "image", side(part["width"]) * side(part["height"]))
        .when(kind == "audio", F.ceil(part["seconds"] * F.lit(PER_SECOND)))
        .when(kind == "document", part["pages"] * F.lit(PER_PAGE))
    )
    name = F.when(known, kind).otherwise(F.lit("attachment"))
    return F.struct(
        F.when(is_text, F.lit("text")).otherwise(name).alias("kind"),
        F.when(is_text, escape(F.coalesce(part["text"], F.lit(""))))
        .otherwise(F.concat(F.lit("<|"), name, F.lit("|>")))
        .alias("out"),
        F.when(~is_text, part["ref"]).alias("ref"),
        F.when(~is_text, F.greatest(F.coalesce(tokens.cast("long"), F.lit(1)), F.lit(1))).alias("tokens"),
    )


def format_conversations(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation. messages: conv_id, turn, role, parts (array of PART); other columns are ignored.

    Returns conv_id; formatted; n_turns; attachments (turn_index, kind, ref, tokens), the k-th belonging to the k-th
    placeholder; expanded_tokens, their sum; and loss_spans, the code points under the loss mask: for each turn a list of
    (start, length) in that turn's block, counted from ``<|im_start|>``. Placeholders are outside the mask.

    Rows go by turn; null turns come first, equal turns go by role, then content, and repeated rows are turns each. Null
    roles, parts and texts are empty; a null conv_id is a conversation of its own; attachments of unknown kind are
    ``<|attachment|>`` of one token, as are sizes that are null. No rows: no conversations. A conversation is one row of
    output, so its turns meet in one task; nothing else is gathered. Work is linear in the turns and their texts.
    """
    visited = F.transform(F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")), _visit)
    role = F.regexp_replace(escape(F.coalesce(F.col("role").cast("string"), F.lit(""))), "\n", BREAK)
    turns = messages.select(
        "conv_id", F.struct(F.col("turn"), role.alias("role"), visited.alias("parts")).alias("t")
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    content = lambda t: F.array_join(F.transform(t["parts"], lambda p: p["out"]), "")
    block = lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), content(t), F.lit(END))

    def spans(t: Column) -> Column:
        header = F.length(t["role"]) + F.lit(len(START) + 1)
        ends = F.aggregate(
            t["parts"], F.array(header), lambda found, p: F.concat(found, F.array(F.element_at(found, -1) + F.length(p["out"])))
        )
        every = F.zip_with(
            t["parts"], ends,
            lambda p, start: F.struct(start.alias("start"), F.length(p["out"]).alias("length"), (p["kind"] == "text").alias("text")),
        )
        trained = F.filter(every, lambda s: s["text"] & (s["length"] > 0))  # also drops what follows the last part
        bare = F.transform(trained, lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
        return F.when(t["role"].isin(*loss_roles), bare).otherwise(F.slice(bare, 1, 0))

    attached = F.flatten(
        F.transform(
            "turns",
            lambda t, i: F.transform(
                F.filter(t["parts"], lambda p: p["kind"] != "text"),
                lambda p: F.struct(i.alias("turn_index"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")),
            ),
        )
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("turns", block), "").alias("formatted"),
        F.size("turns").cast("long").alias("n_turns"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("expanded_tokens"),
        F.transform("turns", spans).alias("loss_spans"),
    )


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string; placeholders stay in the text, told from text by their ``<|``."""
    blocks = turn_blocks(formatted)
    body = F.transform(blocks, lambda b: F.substring(b, F.lit(len(START) + 1), F.length(b)))

    def turn(b: Column) -> Column:
        head = F.substring_index(b, "\n", 1)
        return F.struct(
            unescape(F.replace(head, F.lit(BREAK), F.lit("\n"))).alias("role"),
            unescape(F.substring(b, F.length(head) + 2, F.length(b))).alias("text"),
        )

    return F.transform(body, turn)


def turn_blocks(formatted: Column) -> Column:
    """The blocks of a formatted string, each without its end mark."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.slice(parts, 1, F.size(parts) - 1)


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order; each span is cut from its own turn's block."""
    return F.flatten(
        F.zip_with(
            turn_blocks(formatted), spans,
            lambda block, own: F.transform(own, lambda s: unescape(F.substring(block, s["start"] + 1, s["length"]))),
        )
    )
