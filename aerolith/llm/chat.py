"""Chat formatting: typed content parts, a turn template with reversible escapes, and a loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerolith.llm.common import let, running_sums

# Template. All control strings begin with "<|".
OPEN, CLOSE, LINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"
PART = "array<struct<type:string,text:string,ref:string,units:long>>"
#: Tokens an attachment stands for: a unit is an image tile, a second of audio, a page of a document.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 800}


def escape(text: Column) -> Column:
    """No control string remains: each ``<|`` (with any ``~`` between) gets one more ``~``."""
    return F.regexp_replace(text, r"<(~*)\|", r"<~$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<~(~*)\|", r"<$1|")


class PartVisitor:
    """What each type of content part becomes: (rendered, type, ref, tokens). A subclass may change or add types.

    A part without a type is text: it is escaped later, joined with the text
    parts next to it, for a control string may begin in one and end in the next.
    """

    types = ("text", "image", "audio", "document")

    def text(self, part: Column) -> Column:
        return self._result(F.coalesce(part["text"], F.lit("")), None, part)

    def image(self, part: Column) -> Column:
        return self._attachment("image", part)

    def audio(self, part: Column) -> Column:
        return self._attachment("audio", part)

    def document(self, part: Column) -> Column:
        return self._attachment("document", part)

    def visit(self, part: Column) -> Column:
        """The part through the method of its type; a null or unknown type counts as text."""
        out = self.text(part)
        for kind in self.types[1:]:
            out = F.when(part["type"] == kind, getattr(self, kind)(part)).otherwise(out)
        return out

    def _attachment(self, kind: str, part: Column) -> Column:
        return self._result(F.lit(f"<|{kind}|>"), kind, part)

    def _result(self, rendered: Column, kind: str | None, part: Column) -> Column:
        tokens = F.coalesce(part["units"], F.lit(1)) * TOKENS_PER_UNIT[kind] if kind else F.lit(0)
        return F.struct(
            rendered.alias("rendered"),
            F.lit(kind).cast("string").alias("type"),
            (part["ref"] if kind else F.lit(None)).cast("string").alias("ref"),
            tokens.cast("long").alias("tokens"),
        )


def text_parts(text: Column) -> Column:
    """A plain text as content: one text part (null: empty)."""
    none = F.lit(None)
    part = F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), none.cast("string").alias("ref"), none.cast("long").alias("units"))
    return F.array(part).cast(PART)


def joined_parts(parts: Column) -> Column:
    """Rendered parts one after another; neighbouring texts are escaped as one."""
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("open"))

    def step(s: Column, p: Column) -> Column:
        text = F.struct(s["done"].alias("done"), F.concat(s["open"], p["rendered"]).alias("open"))
        other = F.struct(F.concat(s["done"], escape(s["open"]), p["rendered"]).alias("done"), F.lit("").alias("open"))
        return F.when(p["type"].isNull(), text).otherwise(other)

    mixed = F.aggregate(parts, start, step, lambda s: F.concat(s["done"], escape(s["open"])))
    texts = escape(F.array_join(F.transform(parts, lambda p: p["rendered"]), ""))
    return F.when(F.exists(parts, lambda p: p["type"].isNotNull()), mixed).otherwise(texts)


def format_chats(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    content_col: str = "content",
    visitor: PartVisitor | None = None,
) -> DataFrame:
    """One formatted conversation per row: (conv_id, formatted, loss_spans, attachments, expanded_tokens).

    Turns come in order of ``turn``, ties by role, then content; null turns
    first. A null role or content counts as empty. Placeholders stand in the
    order of ``attachments`` (turn, type, ref, tokens), which hold the
    references and the tokens each placeholder expands to. ``loss_spans`` are
    the code points (start, end) of assistant content. A conversation is one
    record: its turns meet in one row.
    """
    visitor = visitor or PartVisitor()
    content = F.coalesce(F.col(content_col).cast(PART), F.array().cast(PART))
    turns = rows.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            content.alias("content"),
        ).alias("t"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def rendered(t: Column) -> Column:
        def whole(parts: Column) -> Column:
            body = joined_parts(parts)
            head = F.concat(F.lit(OPEN), F.replace(escape(t["role"]), F.lit("\n"), F.lit(LINE)), F.lit("\n"))
            return F.struct(
                t["turn"].cast("long").alias("turn"), t["role"].alias("role"), head.alias("head"), body.alias("body"),
                F.filter(parts, lambda p: p["type"].isNotNull()).alias("attached"),
            )

        return let(F.transform(t["content"], visitor.visit), whole)

    made = grouped.select("conv_id", F.transform("turns", rendered).alias("turns"))

    def spans(turns_: Column) -> Column:
        sizes = F.transform(turns_, lambda t: F.length(t["head"]) + F.length(t["body"]) + len(CLOSE))
        placed = F.zip_with(
            turns_, running_sums(sizes),
            lambda t, at: F.struct(
                t["role"].alias("role"),
                (at + F.length(t["head"])).cast("long").alias("start"),
                (at + F.length(t["head"]) + F.length(t["body"])).cast("long").alias("end"),
            ),
        )
        return F.transform(F.filter(placed, lambda s: s["role"] == "assistant"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    attached = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                t["attached"],
                lambda p: F.struct(t["turn"].alias("turn"), p["type"].alias("type"), p["ref"].alias("ref"), p["tokens"].alias("tokens")),
            ),
        )
    )
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    return made.select(
        "conv_id",
        text.alias("formatted"),
        let(F.col("turns"), spans).alias("loss_spans"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda s, p: s + p["tokens"]).alias("expanded_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_text): roles and texts parsed from the formatted string alone, and the unescaped text under the mask.

    Placeholders stay as they are in the texts.
    """
    each = F.split("formatted", F.lit(r"\Q" + CLOSE + r"\E"), -1)
    each = F.filter(each, lambda x: x != "")

    def parsed(turn: Column) -> Column:
        rest = F.substring(turn, len(OPEN) + 1, 1 << 30)
        role = F.substring_index(rest, "\n", 1)
        return F.struct(
            unescape(F.replace(role, F.lit(LINE), F.lit("\n"))).alias("role"),
            unescape(rest.substr(F.length(role) + 2, F.lit(1 << 30))).alias("text"),
        )

    masked = F.transform("loss_spans", lambda s: unescape(F.col("formatted").substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.withColumns({"turns": F.transform(each, parsed), "loss_text": F.array_join(masked, "")})


def probe_rows(spark: SparkSession) -> DataFrame:
    """Conversation -7: control strings of another template as texts."""
    text = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")


def illustrated_parts(text: Column) -> Column:
    """A text as two halves, next to each other or around an attachment, whose kind and size the text's length gives."""
    whole = F.coalesce(text, F.lit(""))
    half = F.floor(F.length(whole) / 2).cast("int")
    halves = [whole.substr(F.lit(1), half), whole.substr(half + 1, F.length(whole))]
    none = F.lit(None)
    kind = F.get(F.array(*[F.lit(k) for k in ("image", "audio", "document")]), (F.length(whole) % 4).cast("int"))
    units = F.when(kind == "document", none).otherwise(F.length(whole) % 5 + 1).cast("long")
    part = lambda kind_, text_, ref, n: F.struct(kind_.alias("type"), text_.alias("text"), ref.cast("string").alias("ref"), n.cast("long").alias("units"))
    one, two = (part(F.lit("text"), h, none, none) for h in halves)
    attached = part(kind, none.cast("string"), F.concat(F.lit("ref-"), F.length(whole)), units)
    return F.when(kind.isNull(), F.array(one, two)).otherwise(F.array(one, attached, two)).cast(PART)


def oracle() -> str:
    """DuckDB SQL of the registered query."""
    escaped = "length(regexp_replace({c}, '<(~*)\\|', '<~\\1|', 'g'))"
    role = f"{escaped.format(c='role')} + (length(role) - length(replace(role, chr(10), ''))) * {len(LINE) - 1}"
    # fmt: off
    return f"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
    rich AS (
      SELECT *, substring(text, 1, length(text) // 2) AS one, substring(text, length(text) // 2 + 1) AS two,
             CASE length(text) % 4 WHEN 0 THEN 'image' WHEN 1 THEN 'audio' WHEN 2 THEN 'document' END AS kind
      FROM turns)
    SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum({len(OPEN) + 1 + len(CLOSE)} + {role} + {escaped.format(c='text')})::BIGINT AS formatted_chars,
           count(kind) AS n_attachments,
           coalesce(sum(CASE kind WHEN 'document' THEN {TOKENS_PER_UNIT['document']} WHEN 'image' THEN (length(text) % 5 + 1) * {TOKENS_PER_UNIT['image']}
                             WHEN 'audio' THEN (length(text) % 5 + 1) * {TOKENS_PER_UNIT['audio']} END), 0)::BIGINT AS expanded_tokens,
           coalesce(string_agg(kind || ':ref-' || length(text), ',' ORDER BY turn, role, kind, text) FILTER (kind IS NOT NULL), '') AS attachment_refs,
           sum({len(OPEN) + 1 + len(CLOSE)} + {role} + CASE WHEN kind IS NULL THEN {escaped.format(c='text')}
               ELSE {escaped.format(c='one')} + {escaped.format(c='two')} + length(kind) + 4 END)::BIGINT AS illustrated_chars
    FROM rich GROUP BY conv_id"""
    # fmt: on
