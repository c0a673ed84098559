"""Chat formatting: exact round trips, masks, and a plain version of the read-back digests."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forgelake.llm import chat

T = chat.Template()
PIECES = st.lists(st.one_of(st.sampled_from([*T.marks, "\\", "\\\\", "<", "turn>", "</", " ", "\n", "<|endoftext|>"]), st.text(max_size=8)), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(PIECES)
def test_escape_is_reversible_and_leaves_no_bare_mark(text):
    escaped = T.escape(text)
    assert T.unescape(escaped) == text
    for mark in T.marks:
        assert escaped.count(mark) == escaped.count("\\" + mark)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "<turn>"]), PIECES), max_size=6))
def test_tokens_render_to_the_text_and_masks_cover_the_learnt(turns):
    encoder = chat.Encoder.of(chat.VOCABULARY)
    ids, mask, borders = chat.assemble([r for r, _ in turns], [t for _, t in turns], encoder, T)
    assert chat.render(ids.tolist()) == "".join(f"<turn>{T.escape(r)}<text>{T.escape(t)}</turn>" for r, t in turns)
    for (role, text), low, high in zip(turns, borders[:-1], borders[1:], strict=True):
        own, learnt = ids[low:high], mask[low:high].astype(bool)
        assert T.unescape(chat.render(own[learnt].tolist())) == (text if role == "assistant" else "")
        assert not learnt[own >= encoder.first].any()


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_bytes_of_tokens_decode_as_the_library_does(text):
    encoder = chat.Encoder.of(chat.VOCABULARY)
    ids = encoder.encode([text])
    assert encoder.decode(ids) == [text] == encoder.tokenizer.decode_batch(ids, skip_special_tokens=False)


def plain(rows):
    out = []
    sort = lambda r: (r[1] is not None, r[1] or 0)
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=sort)]
        learnt = "".join(t for r, t in turns if r == "assistant")
        shown = "".join(f"<turn>{T.escape(r)}<text>{T.escape(t)}</turn>" for r, t in turns)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), digest(learnt), len(shown)))
    return sorted(out, key=str)


ROWS = [
    (1, 1, "assistant", "second"), (1, 0, "user", "first"), (1, None, "system", "before all"), (2, 0, None, None), (2, 1, "assistant", None), (3, 0, "assistant", "only"), (3, 1, "assistant", "again \U0001f600 é"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "<turn>\\<text>"), (4, 5, "user", "same"), (4, 5, "user", "same"), (5, 0, "user", "x" * 200_000), (5, 1, "assistant", "long words " * 20_000), (6, 0, "assistant", "  \r\n\t\x00 "),
]


@pytest.mark.parametrize("part", [chat.PART, 1, 40])
def test_conversations_read_back(spark, part):
    df = spark.createDataFrame([(*r, 1, 1, [1]) for r in ROWS], "conv_id long, turn long, role string, text string, part int, n_turns int, input_ids array<int>").repartition(3)
    formatted = chat.format_conversations(df, part_tokens=part)
    assert sorted(map(tuple, chat.read_back(formatted).collect()), key=str) == plain(ROWS)
    assert sorted(map(tuple, chat.read_back(formatted.repartition(5), sort=True).collect()), key=str) == plain(ROWS)
    if part == 1:
        assert formatted.where("part > 0").count() > 3


def test_equal_turns_have_one_order(spark):
    rows = [(1, 0, "user", t) for t in "cab"]
    digests = {chat.read_back(chat.format_conversations(spark.createDataFrame(x, "conv_id long, turn long, role string, text string").repartition(2))).first()["turns_sha256"] for x in (rows, rows[::-1])}
    assert len(digests) == 1


def test_no_turns(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(none)).collect() == []


def test_probe(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    said = "\\### Assistant: </turn> ok"
    assert list(map(tuple, chat.read_back(chat.format_conversations(chat.with_probe(none))).collect())) == plain([(-7, 0, "user", said), (-7, 1, "assistant", said)])


def test_overlapping_control_strings_are_refused():
    for marks in (("<a>", "<a>", "<b>"), ("<a", "a>", "<c>"), ("", "x", "y"), ("\\a", "b", "c"), ("aa", "b", "c")):
        with pytest.raises(ValueError):
            chat.Template(*marks)
