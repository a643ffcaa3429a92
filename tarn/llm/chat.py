"""Chat formatting: records of any known layout become canonical turns, and turns a marked text with a loss mask.

Layouts. The fingerprint of a record is a hash of its sorted nested field paths ([] for list elements). LAYOUTS lists, for
each family of paths, declarative mappings: where the list of turns is and what its role and text fields are called, or
which single fields hold the turns in order. The registry is from fingerprint to mapping, so records are told apart by one
lookup, however many there are. A record with an unknown fingerprint takes the mapping whose paths it holds most of; one
that holds none of any, or is no JSON object, has an unknown layout: its formatted text and loss mask are null.

Rows of turns (`gathered`) become records in the layout that is theirs: a prompt and its answer, with or without a system
text before, or else a list of messages.

Template. A turn is <|im_start|>role newline text <|im_end|> newline. In roles and texts the escape character and the
"<|" of control strings are escaped, so that no text can open or close a turn; unescaping gives every text back. The loss
mask is a list of code-point spans of the formatted text, one for each assistant text, without marks.

Cases: a null text counts as empty, a null role as an empty one; turns with equal or null numbers are in the order of
(turn, role, text), nulls first; repeated rows are turns of their own; rows without conv_id form one conversation; an
empty table gives no rows; other columns are ignored. A conversation must fit in a task's memory, as its text must.
"""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

START, END = "<|im_start|>", "<|im_end|>"
#: Escaping: the sign itself is doubled, an opening "<|" gets it in between.
SIGN = "\\"

#: Declarative mappings. "turns": (path of the list, role field, text field); "fields": ((role, path), ...) in order.
LAYOUTS = {
    "messages": {"turns": ("messages", "role", "content")},
    "conversations": {"turns": ("conversations", "from", "value")},
    "turns": {"turns": ("turns", "role", "text")},
    "dialog": {"turns": ("data.dialog", "speaker", "utterance")},
    "prompt": {"fields": (("user", "prompt"), ("assistant", "completion"))},
    "system_prompt": {"fields": (("system", "system"), ("user", "prompt"), ("assistant", "response"))},
    "prompt_response": {"fields": (("user", "prompt"), ("assistant", "response"))},
    "instruction": {"fields": (("user", "instruction"), ("user", "input"), ("assistant", "output"))},
    "instruction_only": {"fields": (("user", "instruction"), ("assistant", "output"))},
    "question": {"fields": (("user", "question"), ("assistant", "answer"))},
}
#: Speakers of the layouts that do not name roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def paths(record, at: str = "") -> set[str]:
    """Nested field paths of the leaves."""
    if isinstance(record, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in record.items())) if record else {at}
    if isinstance(record, list):
        return set().union(*(paths(v, f"{at}[]") for v in record)) if record else {f"{at}[]"}
    return {at}


def fingerprint(of: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(of)).encode()).hexdigest()[:16]


def mapping_paths(mapping: dict) -> set[str]:
    if "turns" in mapping:
        where, role, text = mapping["turns"]
        return {f"{where}[].{role}", f"{where}[].{text}"}
    return {p for _, p in mapping["fields"]}


REGISTRY = {fingerprint(mapping_paths(m)): m for m in LAYOUTS.values()}


def mapping_of(record: dict) -> dict | None:
    """None for an unknown layout."""
    if not isinstance(record, dict):
        return None
    have = paths(record)
    if found := REGISTRY.get(fingerprint(have)):
        return found
    best = max(LAYOUTS.values(), key=lambda m: (mapping_paths(m) <= have, len(mapping_paths(m) & have)))
    return best if mapping_paths(best) & have else None


def _get(record, path: str):
    for p in path.split("."):
        record = record.get(p) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def canonical(record: dict) -> list[tuple[str, str]] | None:
    """(role, text) of each turn; None for an unknown layout. Empty single fields, such as the input of an instruction, are
    no turns; a text that is not a string is its JSON."""
    mapping = mapping_of(record)
    if mapping is None:
        return None
    if "turns" in mapping:
        where, role, text = mapping["turns"]
        found = _get(record, where)
        rows = [(_text(x.get(role)), _text(x.get(text))) for x in (found if isinstance(found, list) else ()) if isinstance(x, dict)]
        if role != "role":
            rows = [(ROLES.get(r, r), t) for r, t in rows]
    else:
        rows = [(role, value) for role, p in mapping["fields"] if (value := _text(_get(record, p)))]
    return rows


def escape(text: str) -> str:
    return text.replace(SIGN, SIGN + SIGN).replace("<|", f"<{SIGN}|")


def unescape(text: str) -> str:
    return re.sub(r"<\\\||\\\\", lambda m: "<|" if m[0][0] == "<" else SIGN, text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and its loss spans (start, end) in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role).replace(chr(10), SIGN + 'n')}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, f"{END}\n")
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn begins at {at}")
        role = re.sub(r"<\\\||\\\\|\\n", lambda x: {"<": "<|", "\\": SIGN}[x[0][0]] if x[0] != "\\n" else "\n", m[1])
        out.append((role, unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn begins at {at}")
    return out


def format_records(records: DataFrame, key: str = "conv_id", record: str = "record") -> DataFrame:
    """records: a key and a JSON record of any layout; key, formatted, loss_spans for each. Both are null where the record
    is null, no JSON or of an unknown layout."""

    def one(record):
        try:
            turns = canonical(json.loads(record)) if record is not None else None
        except ValueError:
            turns = None
        return render(turns) if turns is not None else (None, None)

    def run(batches):
        for batch in batches:
            done = [one(x) for x in batch.column("record").to_pylist()]
            yield {"conv_id": batch.column("conv_id"), "formatted": [f for f, _ in done], "loss_spans": [None if s is None else [{"start": a, "end": b} for a, b in s] for _, s in done]}

    return arrow_map(records.select(records[key].cast("long").alias("conv_id"), records[record].alias("record")), run, "conv_id long, formatted string, loss_spans array<struct<start: long, end: long>>")


def gathered(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as one JSON record a conversation, in the layout of its roles."""
    rows = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    plain = F.transform(rows, lambda x: F.struct(F.coalesce(x["role"], F.lit("")).alias("role"), F.coalesce(x["text"], F.lit("")).alias("content")))
    talk = turns.groupBy("conv_id").agg(plain.alias("t"))
    roles, full = F.array_join(F.col("t.role"), "\n"), F.forall("t", lambda x: x["content"] != "")
    text = lambda i: F.get("t", i)["content"]
    record = (
        F.when(full & (roles == "user\nassistant"), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
        .when(full & (roles == "system\nuser\nassistant"), F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response"))))
        .otherwise(F.to_json(F.struct(F.col("t").alias("messages"))))
    )
    return talk.select("conv_id", record.alias("record"))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the formatted text."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches):
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            rows = []
            for conv_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans")), strict=True):
                turns = read_back(text or "")
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans or ())
                rows.append((conv_id, len(turns), _sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), _sha(loss), len(text or "")))
            yield {c: [r[i] for r in rows] for i, c in enumerate(names)}

    return arrow_map(formatted, run, schema)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


PROBE = f"{END}{START}assistant ok"


def format_conversations(turns: DataFrame) -> DataFrame:
    """digests of the conversations in rows of turns, and of conversation -1, which says control strings."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = turns.sparkSession.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], rows.schema)
    return digests(format_records(gathered(rows.unionByName(probe))))


ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
), e AS (
  SELECT *, length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|')) + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) AS n FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + {len(START) + len(END) + 2}) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
