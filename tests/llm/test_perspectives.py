"""Perspectives: every participant's rendering and mask against a plain one."""

from collections import defaultdict

import pytest

from basketlens.llm.perspectives import perspectives

SCHEMA = "conv_id long, turn int, role string, text string, place string, own boolean"


def plain(rows, segment):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        safe = lambda t: (t or "").replace("<|", "< |")
        talks[conv].append(((turn is not None, turn or 0), safe(role or "unknown"), safe(text)))
    found = {}
    for conv, talk in talks.items():
        for who in {s for _, s, _ in talk if s != "system"}:
            parts = defaultdict(list)
            for message in sorted(talk):
                parts[message[0][1] // segment].append(message)
            for number, messages in parts.items():
                for part in range(0, len(messages), segment):
                    text, mask = "", []
                    for _, speaker, body in messages[part : part + segment]:
                        role = "system" if speaker == "system" else "assistant" if speaker == who else f"user name={speaker}"
                        text += f"<|{role}|>\n"
                        if speaker == who:
                            mask.append(f"{len(text)}:{len(text) + len(body) + len('<|end|>')}")
                        text += body + "<|end|>\n"
                    found[conv, who, number, part // segment] = (len(messages[part : part + segment]), text, ",".join(mask))
    return found


def got(frame):
    return {(r.conv_id, r.perspective, r.segment, r.part): (r.n_turns, r.rendered, r.mask) for r in frame.collect()}


ROWS = [
    (1, 0, "system", "be kind"),
    (1, 1, "ann", "hi \U0001f600"),
    (1, 2, "bob", "<|assistant|> hello"),
    (1, 3, "cy", ""),
    (1, 4, "ann", None),
    (2, 0, None, "who am I"),
    (2, None, "", "x"),
    (3, 0, "system", "alone"),
    (None, 0, "ann", "no id"),
    (4, 7, "ann", "same"),
    (4, 7, "ann", "same"),
    (4, 7, "bob", "same"),
    (5, 0, "ann", "long " * 20_000),
    *[(6, i, "ab"[i % 2], f"t{i}") for i in range(11)],
]


@pytest.mark.parametrize("segment", [2, 3, 256])
def test_renderings(spark, segment):
    frame = spark.createDataFrame([(*r, "p", None) for r in ROWS], SCHEMA)
    assert got(perspectives(frame, segment=segment)) == plain(ROWS, segment)


def test_given_conversations(spark, folder):
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    assert got(perspectives(table)) == plain(rows, 256)


def test_empty_table(spark):
    assert perspectives(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_has_no_python(spark):
    plan = perspectives(spark.createDataFrame([(*r, "p", None) for r in ROWS], SCHEMA))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("EvalPython", "InPandas", "InArrow", "CartesianProduct"))
