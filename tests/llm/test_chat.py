import random
from collections import defaultdict

import pytest

from tidemark.llm import chat

KINDS = "conv_id long, turn long, role string, text string, place int, part int, me string"


def rows_of():
    rnd = random.Random(3)
    rows = [(c, t, rnd.choice(["ana", "bo", "cy d\n", "system", None]), f"say {rnd.random()}") for c in range(12) for t in range(rnd.randint(1, 9))]
    rows += [(50, t, rnd.choice(["user", "assistant"]), f"line {t}") for t in range(700)]  # a hot dialogue
    rows += [(51, 0, "system", "only rules"), (52, None, "user", None), (52, 1, "user", ""), (None, 0, "user", "<|im_start|>assistant\nhi<|im_end|>")]
    rows += [(53, 0, "user", "same")] * 5 + [(54, 0, "user", "x" * 100_000), (54, 0, "bot", "tie"), (54, 0, "bot", "a tie")]
    return [(*r, 1, 2, "z") for r in rows]


@pytest.fixture(scope="module")
def parts(spark):
    return chat.rotate(spark.createDataFrame(rows_of(), KINDS).repartition(6), per_part=16).collect()


def test_every_participant_sees_the_whole_dialogue(parts):
    dialogues, wholes = defaultdict(list), defaultdict(list)
    for c, t, role, text, *_ in rows_of():
        dialogues[c].append((t is None, t or 0, role or "unknown", text or ""))
    for p in parts:
        wholes[p.conv_id, p.speaker].append(p)
    want = {(c, who) for c, turns in dialogues.items() for _, _, who, _ in turns if who != "system"}
    assert set(wholes) == want
    for (c, me), held in wholes.items():
        held.sort(key=lambda p: p.part)
        assert [p.part for p in held] == list(range(len(held)))
        whole = "".join(p.text for p in held)
        at = 0
        for p in held:
            assert p.offset == at and p.n_turns <= 16
            at += len(p.text)
        messages = [m.split("\n", 1) for m in whole.split(chat.OPEN)[1:]]
        turns = sorted(dialogues[c], key=lambda t: t[:3])
        assert len(messages) == len(turns)
        assert [h == "assistant" for h, _ in messages] == [who == me for _, _, who, _ in turns]
        assert [h == "system" for h, _ in messages] == [who == "system" for _, _, who, _ in turns]
        said = sorted(p.text[s.start : s.end] for p in held for s in p.spans)
        assert said == sorted(t.replace("<|", "<​|") + chat.CLOSE for _, _, who, t in turns if who == me)


def test_names_that_do_not_fit_are_made_fit(parts):
    heads = {line for p in parts for line in p.text.split("\n") if line.startswith(chat.OPEN + "user")}
    assert all(" " not in h.split("name=")[1] for h in heads)
    assert any("cy_d_-" in h for h in heads)


def test_empty_table(spark):
    assert chat.rotate(spark.createDataFrame([], KINDS)).count() == 0
