"""Chat formatting: tool calls linked to their results.

Messages ``(conv_id, turn, role, text)`` become events. A text that is a JSON object
with ``tool_calls`` holds calls (``id``, ``function.name``, ``function.arguments``), one
with ``tool_call_id`` is the result of that call, every other text is a plain message.
With ``turn_tool`` the turns of a plain chat are such events themselves: a user turn is
a call of that tool with ``{"text": ...}`` and id ``conv:turn``, an assistant turn the
result of the turn before it.

Calls and results are hash-joined by conversation and identifier. The order is
topological: events keep their turn order, but a result stands after its call and a
call that names another's result (``{"$result": id}`` in its arguments) stands after
that result, whatever the turns say. Arguments are checked against the tool's JSON
schema. Every event is written as canonical JSON (sorted keys, no spaces, UTF-8).
The output has one row per event, so a conversation of any length is never gathered.

Defined cases: null or empty texts are messages with empty content; JSON that is broken,
nested deeper than ``MAX_NESTING``, or holds numbers or characters that cannot be written
back (NaN, infinities, lone surrogates) counts as not JSON: such a message is plain, such
arguments stay a string with the reason ``not JSON``; white space before a JSON object is
allowed; a null conversation id is a conversation of its own; a repeated call or result
of one id is kept with status ``duplicate`` (the first by turn and content is linked, of
wholly equal rows one); a result without a call is an ``orphan``, a call without a result
``unanswered``; calls on a reference cycle, or between two cycles, get status ``cycle``,
what only depends on a cycle does not; an unknown tool or bad arguments give
``valid = false`` and the reasons; an empty table gives no rows; extra columns of the
input are not read.
"""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVENT = ("conv string, turn long, sub int, role string, kind string, call_id string, name string, arguments string, "
         "content string, refs array<string>")
MAX_NESTING = 200
RUN = 4096                     # equal rows are expanded in runs of this length


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _number(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise ValueError(f"{text} is not a finite number")
    return value


def _nothing(text: str):
    raise ValueError(f"{text} is not JSON")


def read_json(text: str):
    """The value of a JSON text that ``canonical`` can write back; ValueError otherwise."""
    try:
        value = json.loads(text, parse_float=_number, parse_constant=_nothing)
    except RecursionError:
        raise ValueError("nested too deep") from None
    level, deep = [value], 0
    while level:                                             # level by level, not by recursion
        deep += 1
        if deep > MAX_NESTING:
            raise ValueError("nested too deep")
        level = [v for x in level if isinstance(x, (dict, list)) for v in (x.values() if isinstance(x, dict) else x)]
    if "\\u" in text:
        try:
            canonical(value).encode("utf-8")
        except UnicodeEncodeError:
            raise ValueError("a lone surrogate") from None
    return value


def _references(value) -> list[str]:
    if isinstance(value, dict):
        own = [value["$result"]] if isinstance(value.get("$result"), str) else []
        return own + [r for v in value.values() for r in _references(v)]
    return [r for v in value for r in _references(v)] if isinstance(value, list) else []


def _parsed(text: str):
    if text.lstrip(" \t\n\r")[:1] != "{":
        return None
    try:
        value = read_json(text)
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def _as_arguments(raw) -> tuple[str, object]:
    """Arguments as canonical JSON and their value; a string that is not JSON stays as it is, without a value."""
    if isinstance(raw, str):
        try:
            raw = read_json(raw)
        except ValueError:
            return raw, None
    raw = {} if raw is None else raw
    return canonical(raw), raw


def message_events(conv: str, turn: int | None, role: str | None, text: str | None, turn_tool: str | None) -> list[tuple]:
    text, value = text or "", _parsed(text or "")
    if value is not None and isinstance(value.get("tool_calls"), list):
        out = []
        if value.get("content"):
            out.append((conv, turn, 0, role, "message", None, None, None, str(value["content"]), []))
        for k, call in enumerate(value["tool_calls"]):
            call = call if isinstance(call, dict) else {}
            f = call.get("function") if isinstance(call.get("function"), dict) else call
            raw, arguments = _as_arguments(f.get("arguments"))
            refs = sorted(set(_references(arguments)))
            out.append((conv, turn, k + 1, role, "call", None if call.get("id") is None else str(call["id"]),
                        None if f.get("name") is None else str(f["name"]), raw, None, refs))
        return out
    if value is not None and value.get("tool_call_id") is not None:
        content = value.get("content")
        return [(conv, turn, 0, role, "result", str(value["tool_call_id"]), None, None,
                 content if isinstance(content, str) else canonical(content), [])]
    if turn_tool and turn is not None and role == "user":
        return [(conv, turn, 0, role, "call", f"{conv}:{turn}", turn_tool, canonical({"text": text}), None, [])]
    if turn_tool and turn is not None and role == "assistant":
        return [(conv, turn, 0, role, "result", f"{conv}:{turn - 1}", None, None, text, [])]
    return [(conv, turn, 0, role, "message", None, None, None, text, [])]


def events(messages: DataFrame, turn_tool: str | None = None) -> DataFrame:
    def run(batches):
        for b in batches:
            rows = [e for c, t, r, x in zip(b["conv"], b["turn"], b["role"], b["text"])
                    for e in message_events(c, None if pd.isna(t) else int(t), r, x, turn_tool)]
            out = pd.DataFrame(rows, columns=[c.split(" ")[0] for c in EVENT.split(", ")])
            out["turn"] = out["turn"].astype("Int64")
            yield out

    src = messages.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("\x00")).alias("conv"), F.col("turn").cast("long").alias("turn"),
                          F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return src.mapInPandas(run, EVENT)


# ---- schema check ---------------------------------------------------------

_KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value, kind: str) -> bool:
    if kind in ("number", "integer"):
        return isinstance(value, (int, float)) and not isinstance(value, bool) and (kind == "number" or isinstance(value, int) or value.is_integer())
    return isinstance(value, _KINDS.get(kind, object))


def schema_errors(value, schema: dict, at: str = "$") -> list[str]:
    """Violations of a JSON schema (type, enum, bounds, lengths, properties, items)."""
    kinds = schema.get("type")
    if kinds and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: type"]
    out = [f"{at}: enum"] if "enum" in schema and value not in schema["enum"] else []
    if _is(value, "number"):
        out += [f"{at}: minimum"] if value < schema.get("minimum", value) else []
        out += [f"{at}: maximum"] if value > schema.get("maximum", value) else []
    if isinstance(value, (str, list)):
        low, high = ("minLength", "maxLength") if isinstance(value, str) else ("minItems", "maxItems")
        out += [f"{at}: {low}"] if len(value) < schema.get(low, 0) else []
        out += [f"{at}: {high}"] if len(value) > schema.get(high, len(value)) else []
    if isinstance(value, list) and "items" in schema:
        out += [e for k, v in enumerate(value) for e in schema_errors(v, schema["items"], f"{at}[{k}]")]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: required" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: unknown" for k in sorted(value) if k not in known]
        out += [e for k in sorted(value) if k in known for e in schema_errors(value[k], known[k], f"{at}.{k}")]
    return out


def _written(schemas: dict[str, dict]):
    def run(kind: pd.Series, call_id: pd.Series, name: pd.Series, arguments: pd.Series, content: pd.Series,
            role: pd.Series, status: pd.Series) -> pd.DataFrame:
        rows = []
        for k, i, f, a, c, r, s in zip(kind, call_id, name, arguments, content, role, status):
            errors: list[str] = []
            body = {"kind": k, "role": r, "status": s}
            if k == "call":
                try:
                    value = read_json(a)
                    errors = schema_errors(value, schemas[f]) if f in schemas else ["$: unknown tool"]
                except ValueError:
                    value, errors = a, ["$: not JSON"]
                if i is None:
                    errors = [*errors, "$: no id"]
                body |= {"id": i, "name": f, "arguments": value}
            else:
                body |= {"content": c} | ({"id": i} if k == "result" else {})
            rows.append((not errors if k == "call" else None, "; ".join(errors) or None, canonical(body)))
        return pd.DataFrame(rows, columns=["valid", "errors", "json"])

    return F.pandas_udf(run, "valid boolean, errors string, json string")


def _marked_cycles(calls: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(edges, cycle)``: the calls on cycles, and the edges that do not lead to one.
    Calls without an open reference are taken away until none is left to take, then
    calls that no open call refers to; what remains lies on a cycle or between two."""
    open_ = edges.select("conv", F.col("call_id").alias("a"), F.col("ref").alias("b")).distinct().checkpoint()
    for end, start in (("b", "a"), ("a", "b")):
        left = -1
        while left != (left := open_.count()) and left:
            starts = open_.select("conv", F.col(start).alias(end)).distinct()
            open_ = open_.join(starts, ["conv", end], "left_semi").checkpoint()
    cycle = open_.select("conv", F.explode(F.array("a", "b")).alias("call_id")).distinct().checkpoint()
    return edges.join(cycle.withColumnRenamed("call_id", "ref"), ["conv", "ref"], "left_anti").checkpoint(), cycle


def _spread_references(e: DataFrame) -> DataFrame:
    """Moves calls behind the results they name; ``cycle`` marks those that never settle.
    One round per link of the longest chain of references, until nothing moves."""
    e = e.withColumn("cycle", F.lit(False))
    if e.where((F.col("kind") == "call") & (F.size("refs") > 0)).isEmpty():
        return e
    spots = e.where("kind = 'call'").select("conv", "call_id", "refs", "at", "phase", "pair_at", "pair_phase").checkpoint()
    done = spots.groupBy("conv", "call_id").agg(F.max(F.struct("at", "phase")).alias("p"), F.max(F.struct(
        F.greatest("at", "pair_at").alias("at"), F.greatest("phase", "pair_phase").alias("phase"))).alias("after")).checkpoint()
    edges = (spots.select("conv", "call_id", F.explode("refs").alias("ref")).distinct()
             .join(done.select("conv", F.col("call_id").alias("ref")), ["conv", "ref"], "left_semi"))
    edges, cycle = _marked_cycles(done, edges)
    step = lambda b: F.struct(F.col(f"{b}.at").alias("at"), (F.col(f"{b}.phase") + 1).alias("phase"))
    while True:
        need = (edges.join(done.select("conv", F.col("call_id").alias("ref"), F.col("after").alias("b")), ["conv", "ref"])
                .groupBy("conv", "call_id").agg(F.max("b").alias("b")))
        done = (done.join(need, ["conv", "call_id"], "left")
                .withColumn("late", F.col("b").isNotNull() & (step("b") > F.col("p")))
                .withColumn("p", F.when(F.col("late"), step("b")).otherwise(F.col("p")))
                .withColumn("after", F.when(F.col("late"), F.greatest(F.col("after"), step("p"))).otherwise(F.col("after")))
                .select("conv", "call_id", "p", "after", "late").checkpoint())
        if done.where("late").isEmpty():
            break
        done = done.drop("late")
    out = e.join(done.drop("late"), ["conv", "call_id"], "left")
    out = (out.withColumn("phase", F.when(F.col("p").isNull(), F.col("phase")).when(F.col("kind") == "call", F.col("p.phase"))
                          .when(F.struct("at", "phase") > F.col("p"), F.col("phase")).otherwise(F.col("p.phase") + 1))
              .withColumn("at", F.when(F.col("p").isNull(), F.col("at")).when(F.col("kind") == "call", F.col("p.at"))
                          .otherwise(F.greatest("at", F.col("p.at")))).drop("p", "after"))
    marked = cycle.withColumn("stuck", F.lit(True))
    return out.join(marked, ["conv", "call_id"], "left").withColumn("cycle", F.coalesce("stuck", F.lit(False))).drop("stuck")


def _numbered(e: DataFrame) -> DataFrame:
    """Adds ``copy``: 0 for the first of wholly equal named events, then 1, 2, ... They are
    counted before the shuffle and expanded again, so many copies of one row never meet."""
    counted = e.groupBy(*e.columns).agg(F.count(F.lit(1)).alias("k"))
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(k - 1) div {RUN}"))))
    return (runs.withColumn("copy", F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("run") * RUN + RUN, F.col("k")) - 1)))
            .drop("k", "run"))


def link(messages: DataFrame, schemas: dict[str, dict], turn_tool: str | None = None) -> DataFrame:
    """One row per event: ``conv_id, turn, sub, kind, call_id, status, partner_turn, order_turn,
    order_phase, valid, errors, json``. Sort by ``order_turn, order_phase, turn, sub`` in a conversation."""
    e = events(messages, turn_tool)
    plain = e.where(F.col("call_id").isNull()).withColumn("copy", F.lit(0).cast("long"))
    named = _numbered(e.where(F.col("call_id").isNotNull()))
    tie = F.md5(F.concat_ws("\x00", F.coalesce("role", F.lit("\x01")), F.coalesce("name", F.lit("\x01")), F.coalesce("arguments", "content", F.lit("\x01"))))
    e = named.unionByName(plain).withColumn("tie", tie)
    named = e.where(F.col("call_id").isNotNull())
    first = lambda kind: F.min(F.when(F.col("kind") == kind, F.struct("turn", "sub", "tie", "copy")))
    pair = named.groupBy("conv", "call_id").agg(first("call").alias("c"), first("result").alias("r"))
    e = e.join(pair, ["conv", "call_id"], "left")
    here = F.struct("turn", "sub", "tie", "copy")
    own = F.when(F.col("kind") == "call", F.col("c")).otherwise(F.col("r"))
    other = F.when(F.col("kind") == "call", F.col("r")).otherwise(F.col("c"))
    status = (F.when(F.col("kind") == "message", F.lit("message"))
              .when(own.isNotNull() & ~here.eqNullSafe(own), F.lit("duplicate"))
              .when(other.isNotNull(), F.lit("linked"))
              .when(F.col("kind") == "call", F.lit("unanswered")).otherwise(F.lit("orphan")))
    late = (F.col("kind") == "result") & (F.col("c.turn") >= F.col("turn"))
    e = e.withColumns({"status": status, "partner_turn": other["turn"],
                       "at": F.when(late, F.col("c.turn")).otherwise(F.col("turn")), "phase": F.when(late, 1).otherwise(0),
                       "pair_at": F.coalesce(F.greatest("c.turn", "r.turn"), F.col("turn")),
                       "pair_phase": F.when(F.col("r.turn") <= F.col("c.turn"), 1).otherwise(0)})
    e = _spread_references(e.drop("c", "r"))
    e = e.withColumn("status", F.when(F.col("cycle"), F.lit("cycle")).otherwise(F.col("status")))
    out = e.withColumn("w", _written(schemas)("kind", "call_id", "name", "arguments", "content", "role", "status"))
    return out.select(F.when(F.col("conv") != "\x00", F.col("conv")).alias("conv_id"), "turn", "sub", "kind", "call_id", "status",
                      "partner_turn", F.col("at").alias("order_turn"), F.col("phase").cast("int").alias("order_phase"),
                      "w.valid", "w.errors", "w.json")
