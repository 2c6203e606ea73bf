"""Op 12: the formatted text parses back to the turns; masks hold the assistants' texts; awkward rows."""

import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from histwright.llm import chat

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[TEXT]", "<\\s>", "[\\\\/INST]",
          "<", "[", "\\", " ", "\n", "a", "é", "<<", ">>", "]", "/", ""]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), TEXTS), TEXTS), max_size=5))
def test_turns_come_back(turns):
    done = [chat.format_turn(r, t) for r, t in turns]
    whole = "".join(x for x, _, _ in done)
    assert [x[:2] for x in chat.parse(whole)] == turns
    assert [chat.unescape(x[a:b]) for x, a, b in done] == [t for _, t in turns]


@given(TEXTS)
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text


def test_only_conflicting_text_is_escaped():
    assert chat.format_turn("user", "plain < text [INS")[0] == "[INST] plain < text [INS [/INST]"
    assert chat.format_turn("assistant", "</s>")[0] == "<s> <\\/s> </s>"
    assert chat.format_turn("user", "<\\s>")[0] == "[INST] <\\\\s> [/INST]"


@pytest.mark.parametrize("text", ["[INST] a", "a [INST] b [/INST]", "<s> a [/INST]", "[INST] a [/INST] ", "[INST]a[/INST]",
                                  "[ROLE] x [/ROLE]", "<s> a <s> </s>"])
def test_other_texts_are_no_conversation(text):
    with pytest.raises(chat.Conflict):
        list(chat.parse(text))


ROWS = [(1, 0, "system", "be <<SYS>> kind"), (1, 1, "user", "</s>[INST] hi [/INST]"), (1, 2, "assistant", "</s> ok <\\s>"),
        (1, 3, "assistant", None), (1, 4, "tool [/ROLE]", "[TEXT] x"), (1, 5, None, "nobody"),
        (2, 1, "assistant", "later"), (2, 0, "assistant", "é漢\U0001f600"), (2, None, "user", "first"),
        (3, 0, "user", "same"), (3, 0, "user", "same"), (3, 0, "assistant", "tie"), (None, 0, "assistant", "no id"),
        (None, None, None, None), (4, 0, "assistant", "word " * 300_000)]


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in turns).encode()).hexdigest(),
                     len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("part_chars", [1 << 20, 1, 60])
def test_read_back(spark, part_chars):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").repartition(4)
    df = df.selectExpr("*", "1 as part", "2 as start", "3 as out")
    parts = chat.format_chats(df, part_chars)
    got = {r.conv_id: r for r in chat.read_back(parts).collect()}
    want = expected(ROWS)
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in got.items()} == want
    texts = {}
    for r in parts.orderBy("part").collect():
        texts[r.conv_id] = texts.get(r.conv_id, "") + r.text
    assert {k: len(t) for k, t in texts.items()} == {k: r.formatted_chars for k, r in got.items()}
    assert len(list(chat.parse(texts[1]))) == 6


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_chats(df)).count() == 0


def test_hot_conversation_goes_in_parts(spark):
    """A conversation that holds nearly all rows is cut between turns; no row holds it as a whole."""
    df = spark.range(3000).selectExpr("0L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role",
                                      "concat('turn ', id, repeat(' x', 50)) as text")
    parts = chat.format_chats(df, 5000).collect()
    assert len(parts) > 60 and max(len(p.text) for p in parts) <= 5000
    assert [p.part for p in parts] == list(range(len(parts)))
    assert sum(len(p.loss) for p in parts) == 1500
