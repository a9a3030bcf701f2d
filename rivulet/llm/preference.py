"""Preference formatting: the common turns of two conversations once as prompt, then masked completions.

Native: the turns of a conversation are an array, and prefix, rendering and
mask are array expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import col, table

TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def conversations(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """``conv_id, turns``: one row per conversation, its turns in order.

    Rows without a conversation id belong to none. Turns with the same number are ordered by role
    and text, those without a number come first; repeated turns stay. A null text is empty, a null
    role is the role ``""``.
    """
    one = F.struct(col(turn).cast("long").alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"),
                   F.coalesce(col(text), F.lit("")).alias("text"))
    return (turns.where(col(conv).isNotNull()).groupBy(col(conv).alias("conv_id"))
            .agg(F.sort_array(F.collect_list(one)).alias("turns")))


def pairs_by_swapped_reply(convs: DataFrame, role: str = "assistant") -> DataFrame:
    """``conv_id, chosen, rejected``: each conversation against itself with another conversation's last reply.

    ``chosen`` is the conversation up to its last reply; in ``rejected`` that reply is the last one of
    the conversation whose id differs in the lowest bit. Where that has no reply (or does not exist)
    the reply is missing in ``rejected``; a conversation without a reply is whole on both sides.
    """
    at = F.array_max(F.transform(F.col("turns"), lambda t, i: F.when(t["role"] == role, i + 1)))
    c = convs.withColumn("at", at)
    other = c.where("at is not null").select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"),
                                             F.array(F.element_at("turns", F.col("at"))).alias("reply"))
    c = c.join(other, "conv_id", "left")
    head = F.slice("turns", 1, F.col("at") - 1)
    return c.select("conv_id",
                    F.when(F.col("at").isNull(), F.col("turns")).otherwise(F.slice("turns", 1, F.col("at"))).alias("chosen"),
                    F.when(F.col("at").isNull(), F.col("turns")).when(F.col("reply").isNull(), head)
                    .otherwise(F.concat(head, "reply")).alias("rejected"))


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of turns (role and text)."""
    both = F.least(F.size(a), F.size(b))
    same = F.transform(F.slice(F.arrays_zip(a.alias("x"), b.alias("y")), 1, F.greatest(both, F.lit(1))),
                       lambda t: (t["x"]["role"] == t["y"]["role"]) & (t["x"]["text"] == t["y"]["text"]))
    first = F.array_position(same, False)
    return F.when(both <= 0, 0).when(first > 0, first - 1).otherwise(both).cast("int")


def _render(t: Column) -> Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("<|end|>\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def trained(turns: Column, role: str = "assistant") -> Column:
    """Character spans ``[start, end)`` of rendered turns that carry loss: the text and end mark of ``role``'s turns."""
    spans = "array<struct<start:int,end:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("spans"))

    def step(acc, t):
        head, end = F.length(t["role"]) + 5, acc["at"] + F.length(_render(t))
        one = F.array(F.struct((acc["at"] + head).cast("int").alias("start"), (end - 1).cast("int").alias("end")))
        return F.struct(end.cast("int").alias("at"),
                        F.when(t["role"] == role, F.concat(acc["spans"], one)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def format_pairs(pairs: DataFrame, *, chosen: str = "chosen", rejected: str = "rejected", role: str = "assistant") -> DataFrame:
    """Adds ``n_common, prompt, chosen_text, chosen_spans, rejected_text, rejected_spans, differs`` to pairs of turn arrays.

    The prompt renders the common turns once; the completions render the rest, with the spans of
    their text that carry loss (all else is masked). Conversations that are equal, or one of which
    begins with all of the other, have empty completions on that side; such pairs stay and
    ``differs`` tells the former. A null conversation has no turns. Rows, and columns with other names, stay. Very long texts are rendered whole.
    """
    a, b = (F.coalesce(col(c), F.array().cast(TURNS)) for c in (chosen, rejected))
    p = pairs.withColumn("n_common", common_turns(a, b))
    n = F.col("n_common")
    rest = lambda t: F.slice(t, n + 1, F.greatest(F.size(t) - n, F.lit(0)))
    return (p.withColumn("prompt", render(F.slice(a, 1, n)))
            .withColumn("chosen_text", render(rest(a))).withColumn("chosen_spans", trained(rest(a), role))
            .withColumn("rejected_text", render(rest(b))).withColumn("rejected_spans", trained(rest(b), role))
            .withColumn("differs", (F.size(a) > n) | (F.size(b) > n)))


def _digest(spans: str) -> Column:
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias(spans)


def op1_preference(spark, sf_dir):
    """A preference pair of every conversation."""
    out = format_pairs(pairs_by_swapped_reply(conversations(table(spark, sf_dir, "conversations"))))
    return out.select("conv_id", "n_common", "prompt", "chosen_text", _digest("chosen_spans"), "rejected_text",
                      _digest("rejected_spans"), "differs")


OP1_SQL = r"""
WITH c AS (SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
             ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
s AS (SELECT *, list_max(list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')) AS l FROM c),
p AS (SELECT x.conv_id, CASE WHEN x.l IS NULL THEN x.t ELSE x.t[1:x.l] END AS a,
        CASE WHEN x.l IS NULL THEN x.t WHEN y.l IS NULL THEN x.t[1:x.l - 1] ELSE list_concat(x.t[1:x.l - 1], [y.t[y.l]]) END AS b
      FROM s x LEFT JOIN s y ON y.conv_id = xor(x.conv_id, 1)),
q AS (SELECT *, len(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[1:i] = b[1:i])) AS m FROM p),
e AS (SELECT conv_id, CAST(m AS INTEGER) AS n_common, a[1:m] AS pre, a[m + 1:] AS a, b[m + 1:] AS b FROM q),
r AS (SELECT *, [struct_pack(role := x.role, s := '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)) FOR x IN pre] AS sp,
        [struct_pack(role := x.role, s := '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)) FOR x IN a] AS sa,
        [struct_pack(role := x.role, s := '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)) FOR x IN b] AS sb FROM e)
SELECT conv_id, n_common,
  coalesce(array_to_string([x.s FOR x IN sp], ''), '') AS prompt,
  coalesce(array_to_string([x.s FOR x IN sa], ''), '') AS chosen_text,
  coalesce(array_to_string(list_transform(list_filter(range(1, len(sa) + 1), lambda i: sa[i].role = 'assistant'),
    lambda i: CAST(coalesce(list_sum(list_transform(sa[1:i - 1], lambda y: length(y.s))), 0) + length(sa[i].role) + 5 AS BIGINT) || '-' ||
         CAST(list_sum(list_transform(sa[1:i], lambda y: length(y.s))) - 1 AS BIGINT)), ','), '') AS chosen_spans,
  coalesce(array_to_string([x.s FOR x IN sb], ''), '') AS rejected_text,
  coalesce(array_to_string(list_transform(list_filter(range(1, len(sb) + 1), lambda i: sb[i].role = 'assistant'),
    lambda i: CAST(coalesce(list_sum(list_transform(sb[1:i - 1], lambda y: length(y.s))), 0) + length(sb[i].role) + 5 AS BIGINT) || '-' ||
         CAST(list_sum(list_transform(sb[1:i], lambda y: length(y.s))) - 1 AS BIGINT)), ','), '') AS rejected_spans,
  len(a) > 0 OR len(b) > 0 AS differs
FROM r
"""
