"""Second reading of empty cells by an injected model: attempts, feedback and escalation as a small state machine."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: call(prompt, model, tag) gives an answer: {"value", "segments", "ref"}; value None means the documents are silent.
Call = Callable[[str, str, str], dict]
#: check(answer) gives (status, detail).
Check = Callable[[dict], tuple[str, str]]
_REJECTED = ("REJECT_CONTAINMENT", "REJECT_SUPPORT")
_DONE = ("PASS", "NULL_OK")


@dataclass(frozen=True)
class Outcome:
    status: str
    value: str | None
    attempts: int
    escalated: bool


class CannedCalls:
    """Answers from a table by (model, tag), then tag; for tests and replays."""

    def __init__(self, answers: dict):
        self.answers = answers

    def __call__(self, prompt: str, model: str, tag: str) -> dict:
        base = tag.rsplit("#", 1)[0]
        for k in ((model, tag), tag, (model, base), base):
            if k in self.answers:
                return self.answers[k]
        raise KeyError(tag)


def prompt_for(field: str, documents: list[tuple[str, str]], feedback: str = "") -> str:
    """What is asked, verbatim texts included so that copies stay verbatim."""
    parts = [f"Field: {field}. Copy the value and its evidence word for word, or say that the documents are silent."]
    if feedback:
        parts.append(f"The last answer was refused: {feedback}")
    return "\n\n".join(parts + [f"[{ref}]\n{text}" for ref, text in documents])


def second_reading(field: str, documents: list[tuple[str, str]], call: Call, check: Check, models: tuple[str, str] = ("small", "large"), tag: str = "") -> Outcome:
    """Small model, once more with feedback after a refusal, then the large one; documents missing need no call."""
    if not documents:
        return Outcome("NULL_OK", None, 0, False)
    refs = {ref for ref, _ in documents}

    def attempt(n: int, model: str, feedback: str) -> tuple[str, str, str | None]:
        try:
            answer = call(prompt_for(field, documents, feedback), model, f"{tag}#{n}")
        except Exception as e:  # whatever the adapter raises is a failed attempt
            return "PARSE_FAILURE", str(e), None
        if answer.get("value") is not None and answer.get("ref") not in refs:
            return "PARSE_FAILURE", "the cited document is none of the candidates", None
        status, detail = check(answer)
        return status, detail, answer.get("value") if status == "PASS" else None

    status, detail, value = attempt(1, models[0], "")
    n = 1
    if status in _REJECTED:
        status, detail, value = attempt(2, models[0], detail)
        n = 2
    if status in _DONE:
        return Outcome(status, value, n, False)
    status, detail, value = attempt(n + 1, models[1], detail if status in _REJECTED else "")
    return Outcome(status, value, n + 1, True)


READ = T.StructType([T.StructField("program_id", T.StringType()), T.StructField("field", T.StringType()), T.StructField("status", T.StringType()), T.StructField("value", T.StringType()), T.StructField("attempts", T.IntegerType()), T.StructField("escalated", T.BooleanType())])


def read_cells(cells: DataFrame, make_call: Callable[[], Call], check: Check) -> DataFrame:
    """READ rows of cells (program_id, field, documents array<struct<ref,text>>); the adapter is made once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make_call()
        for b in batches:
            rows = []
            for program, field, docs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                o = second_reading(field, [(d["ref"], d["text"]) for d in docs or []], call, check, tag=f"{program}:{field}")
                rows.append((program, field, o.status, o.value, o.attempts, o.escalated))
            if rows:
                kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=READ.names)

    return cells.select("program_id", "field", "documents").mapInArrow(run, READ)
