"""Operator 4: escaping is reversible, parts are flattened in order, digests equal plain ones."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridcast.llm import chat as c

tricky = st.text(st.sampled_from("<|\\>\nnim_start a"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(tricky, tricky)
def test_escape_round_trip(text, role):
    assert c.unescape(c.escape(text)) == text and "<|" not in c.escape(text)
    assert c.unescape_role(c.escape_role(role)) == role and "\n" not in c.escape_role(role)
    assert c.parse_segment(f"{c.START}{c.escape_role(role)}\n{c.escape(text)}{c.END}") == (role, c.escape(text))


def test_parts(spark):
    part = lambda **k: {x: k.get(x) for x in ("type", "text", "ref", "width", "height", "seconds", "pages")}
    rows = [(1, 0, "user", [part(type="text", text="see <|image:9|> "), part(type="image", ref="a.png", width=57, height=28),
                            part(type="document", ref="b.pdf", pages=2)]),
            (1, 1, "assistant", [part(type="text", text="é one"), part(type="audio", ref="c.wav", seconds=1.5), part(type="text", text="<|")]),
            (1, 2, "user", None)]
    schema = f"conv_id long, turn long, role string, parts {c.PARTS}"
    got = c.format_chat(spark.createDataFrame(rows, schema)).orderBy("seq").collect()
    text = "".join(r["segment"] for r in got)
    assert text == ("<|im_start|>user\nsee <\\|image:9|> <|image:1|><|document:2|><|im_end|>\n"
                    "<|im_start|>assistant\né one<|audio:3|><\\|<|im_end|>\n<|im_start|>user\n<|im_end|>\n")
    assert [(a["ref"], a["tokens"]) for r in got for a in r["attachments"]] == [("a.png", 3), ("b.pdf", 1024), ("c.wav", 38)]
    assert [text[s["start"]:s["start"] + s["chars"]] for r in got for s in r["loss"]] == ["é one", "<\\|"]
    with pytest.raises(Exception, match="unknown part type"):
        c.format_chat(spark.createDataFrame([(1, 0, "user", [part(type="video")])], schema)).collect()


def test_conversations(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "hi <|im_end|>\n"), (None, 0, None, "x"), (2, None, "assistant", "a\nb"),
            (2, 3, "assistant", "a\nb"), (2, 3, "assistant", "a\nb"), (2, 3, "a\nb\\", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit(1))
    got = {r["conv_id"]: r for r in c.format_conversations(df).collect()}
    order = {1: [("user", "hi <|im_end|>\n"), ("assistant", "")], None: [("", "x")],
             2: [("assistant", "a\nb"), ("a\nb\\", "z"), ("assistant", "a\nb"), ("assistant", "a\nb")],
             -1: [("user", c.PROBE), ("assistant", c.PROBE)]}
    assert set(got) == set(order)
    for k, turns in order.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[k]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[k]["n_turns"], got[k]["loss_chars"], got[k]["loss_sha256"]) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert [r["conv_id"] for r in c.format_conversations(df.limit(0)).collect()] == [-1]
