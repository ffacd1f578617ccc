"""Event messages: JSON in and out, validation, action codes and counters.

P1 parse, P2 typed field access, P3 record to JSON, P6 click filter,
P8 one-hot counters, P10 rejects. All built-in column expressions: no UDF.

What makes a message unusable depends on what its reader needs (``needs``):
``_reason`` is the one place that decides, for the parse, the status column,
the reject feed and strict mode alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.schema import ADDCART, BUY, CLICK, EVENT_COLUMNS, EVENT_FIELDS, FOCUS

_CORRUPT = "_corrupt_message"
_WIRE = {column: wire for wire, column in EVENT_FIELDS}

# Reject reasons, in the order in which they are looked for.
MALFORMED = "malformed"
NO_ACTION = "no action"
BAD_ACTION = "bad action"
NO_PROVINCE = "no province"
NO_CATEGORY = "no category"
NO_TIME = "no time"

# What a reader can need, and the fields it reads to tell.
ACTION, PROVINCE, CATEGORY, TIME = "action", "province", "category", "time"
NEED_FIELDS = {ACTION: ["action"], PROVINCE: ["province"], CATEGORY: ["action", "cat_id"], TIME: ["event_ms"]}
ALL_NEEDS = (ACTION, PROVINCE, CATEGORY, TIME)


def action_code(action: Column | str = "action") -> Column:
    """The action as INT; null when it is missing or not a number."""
    c = F.col(action) if isinstance(action, str) else action
    return c.try_cast("int")


def to_messages(df: DataFrame, *keep: str) -> DataFrame:
    """Each event as one JSON text ``value`` in wire names; nulls are left out.

    ``keep`` columns (e.g. an id standing in for the broker offset) ride along.
    """
    body = F.to_json(F.struct(*[F.col(c).alias(w) for w, c in EVENT_FIELDS]))
    return df.select(*keep, body.alias("value"))


def _read_fields(fields: Sequence[str] | None, needs: Sequence[str]) -> list[str]:
    wanted = set(EVENT_COLUMNS if fields is None else fields)
    for need in needs:
        wanted.update(NEED_FIELDS[need])
    return [c for c in EVENT_COLUMNS if c in wanted]


def _parsed(value: str, fields: Sequence[str]) -> Column:
    """Only these fields are read; all arrive as text, so "0" and 0 are alike."""
    schema = T.StructType([T.StructField(_WIRE[c], T.StringType()) for c in [*fields]] + [T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(F.col(value), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def _reason(r: Column, needs: Sequence[str]) -> Column:
    """Why a reader with these needs cannot use the message; null when it can."""
    out = F.when(r[_CORRUPT].isNotNull(), F.lit(MALFORMED))
    if ACTION in needs:
        out = out.when(r["action"].isNull(), F.lit(NO_ACTION)).when(action_code(r["action"]).isNull(), F.lit(BAD_ACTION))
    if PROVINCE in needs:
        out = out.when(r["province"].isNull(), F.lit(NO_PROVINCE))
    if CATEGORY in needs:  # only clicks are counted by category
        out = out.when((action_code(r["action"]) == CLICK) & r["catId"].isNull(), F.lit(NO_CATEGORY))
    if TIME in needs:
        out = out.when(r["timestamp"].try_cast("bigint").isNull(), F.lit(NO_TIME))
    return out


def _field(column: str, r: str = "_r") -> Column:
    c = F.col(f"{r}.{_WIRE[column]}")
    return (c.try_cast("bigint") if column == "event_ms" else c).alias(column)


def parse_with_status(
    messages: DataFrame, *keep: str, needs: Sequence[str] = (ACTION,), value: str = "value"
) -> DataFrame:
    """JSON text to the ten typed event columns, ``action_code`` and ``reject_reason``.

    ``reject_reason`` is null for a usable event. An action that is not an
    integer (e.g. ``""``) is a bad action; unknown but numeric ones such as
    ``"7"`` are kept and count toward no counter. ``event_ms`` is null when the
    message's time is missing or not a number.
    """
    parsed = messages.select(*keep, F.col(value), _parsed(value, EVENT_COLUMNS).alias("_r"))
    return parsed.select(
        *keep,
        F.col(value),
        *map(_field, EVENT_COLUMNS),
        action_code(F.col("_r.action")).alias("action_code"),
        _reason(F.col("_r"), needs).alias("reject_reason"),
    )


def _zero_or_one(messages: DataFrame, keep: tuple[str, ...], value: str, fields: Sequence[str], pred) -> DataFrame:
    # Each message yields zero or one record. Parse and test happen inside
    # one generator, so the JSON is parsed once per message; a plain filter
    # would be pushed below the parse and repeat it for each test.
    rec = F.explode(F.filter(F.array(_parsed(value, fields)), pred))
    return messages.select(*keep, F.col(value), rec.alias("_r"))


def parse_events(
    messages: DataFrame,
    *keep: str,
    strict: bool = False,
    needs: Sequence[str] = (ACTION,),
    fields: Sequence[str] | None = None,
    value: str = "value",
) -> DataFrame:
    """Usable events only: ``keep`` columns, the event columns, and ``action_code`` where the action is read.

    ``strict=True`` fails the job on the first unusable message instead of leaving it
    to the reject feed. ``fields`` narrows what is read from the JSON. With no
    ``needs`` every well-formed message is usable, whatever its action: the item metric reads
    its events this way, and odd actions form their own group there, with all counters zero.
    """
    read = _read_fields(fields, needs)

    if strict:

        def pred(r: Column) -> Column:
            reason = _reason(r, needs)
            err = F.raise_error(F.concat(F.lit("rejected event ("), reason, F.lit("): "), F.col(value)))
            return F.when(reason.isNotNull(), err).otherwise(F.lit(True))

    else:

        def pred(r: Column) -> Column:
            return _reason(r, needs).isNull()

    good = _zero_or_one(messages, keep, value, read, pred)
    shown = EVENT_COLUMNS if fields is None else [c for c in EVENT_COLUMNS if c in fields]
    code = [action_code(F.col("_r.action")).alias("action_code")] if "action" in read else []
    return good.select(*keep, *map(_field, shown), *code)


def reject_events(
    messages: DataFrame, *keep: str, needs: Sequence[str] = (ACTION,), value: str = "value"
) -> DataFrame:
    """P10: the messages that ``parse_events`` with these needs drops, with the raw text and the reason."""
    read = _read_fields((), needs)
    bad = _zero_or_one(messages, keep, value, read, lambda r: _reason(r, needs).isNotNull())
    return bad.select(*keep, value, _reason(F.col("_r"), needs).alias("reject_reason"))


def reasons_by_reader(
    messages: DataFrame, readers: dict[str, Sequence[str]], *keep: str, value: str = "value"
) -> DataFrame:
    """P10 for several readers at once: every message with its event columns and, per reader, why it cannot use it.

    ``reasons`` is an array of ``(job, reason)`` in the order of ``readers``; a null reason means that the
    reader can use the message. The JSON is parsed once for all of them, inside a generator of one row.
    """
    parsed = messages.select(*keep, F.col(value), F.explode(F.array(_parsed(value, EVENT_COLUMNS))).alias("_r"))
    reasons = [
        F.struct(F.lit(name).alias("job"), _reason(F.col("_r"), needs).alias("reason")) for name, needs in readers.items()
    ]
    return parsed.select(
        *keep,
        F.col(value),
        *map(_field, EVENT_COLUMNS),
        action_code(F.col("_r.action")).alias("action_code"),
        F.array(*reasons).alias("reasons"),
    )


def observed_events(
    messages: DataFrame,
    observation: Observation | str,
    *keep: str,
    needs: Sequence[str] = (ACTION,),
    fields: Sequence[str] | None = None,
    value: str = "value",
) -> DataFrame:
    """``parse_events``, counting on the way: ``messages, accepted, rejected`` of whatever action reads the result.

    ``observation`` receives the counts of a batch; a stream reports them by that name in its progress. No pass of
    its own is made over the input.
    """
    read = _read_fields(fields, needs)
    parsed = messages.select(*keep, F.explode(F.array(_parsed(value, read))).alias("_r"))
    parsed = parsed.select(*keep, "_r", _reason(F.col("_r"), needs).alias("_why"))
    bad = F.col("_why").isNotNull()
    counted = parsed.observe(
        observation,
        F.count(F.lit(1)).alias("messages"),
        F.count_if(~bad).alias("accepted"),
        F.count_if(bad).alias("rejected"),
    )
    shown = EVENT_COLUMNS if fields is None else [c for c in EVENT_COLUMNS if c in fields]
    code = [action_code(F.col("_r.action")).alias("action_code")] if "action" in read else []
    return counted.where(~bad).select(*keep, *map(_field, shown), *code)


def with_action_code(df: DataFrame) -> DataFrame:
    return df if "action_code" in df.columns else df.withColumn("action_code", action_code("action"))


def clicks(df: DataFrame) -> DataFrame:
    """Click events only."""
    return with_action_code(df).filter(F.col("action_code") == CLICK)


def action_flags(df: DataFrame) -> DataFrame:
    """One-hot INT counters ``click, addcart, buy, focus``; other actions give zeros.

    One projection: the shared ``action_code`` expression is evaluated once by codegen.
    """
    has_code = "action_code" in df.columns
    code = F.col("action_code") if has_code else action_code("action")

    def flag(k: int) -> Column:
        return F.when(code == k, F.lit(1)).otherwise(F.lit(0))

    cols = {} if has_code else {"action_code": code}
    cols.update({"click": flag(CLICK), "addcart": flag(ADDCART), "buy": flag(BUY), "focus": flag(FOCUS)})
    return df.withColumns(cols)
