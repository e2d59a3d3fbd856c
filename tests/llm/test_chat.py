"""Formatting read back without loss, the mask, typed parts, odd rows."""

import hashlib
import random
import re

import duckdb
from pyspark.sql import functions as F

from terrace.llm import chat
from tests.test_oracle import canon


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        out[conv] = (len(own), sha(said), len(loss), sha(loss))
    return out


def got(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r[0]: tuple(r)[1:5] for r in chat.digest(df).collect()}
    probe = "</s>[INST] ok [/INST]"
    assert found.pop(-1) == brute([(-1, 0, "user", probe), (-1, 1, "assistant", probe)])[-1]
    return found


def test_round_trip_of_random_control_strings(spark):
    rng = random.Random(13)
    bits = ["<", "|", ">", "\\", "/", "s", "[", "]", "INST", "SYS", "turn", "end", "<|turn|>", "<|end|>\n", "</s>", "[/INST]", "é", "\n", " ", "unk", "$1", "<|im_start|>"]
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(1, 5)):
            text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
            rows.append((conv, turn, rng.choice(["user", "assistant", "system"]), text))
    assert got(spark, rows) == brute(rows)


def test_no_control_string_survives_in_a_text(spark):
    text = "".join(f"{c}x" for c in ("<|turn|>", "<|end|>", "<|image|>", "</s>", "<s>", "<unk>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>"))
    row = spark.createDataFrame([(text,), ("plain < text [1] \\ |",)], "t string").select(chat.escape(F.col("t")).alias("e"))
    made, plain = (r.e for r in row.collect())
    assert plain == "plain < text [1] \\ |"
    for c in ("<|turn|>", "<|end|>", "<|image|>", "</s>", "<s>", "<unk>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_end|>"):
        assert c not in made


def test_typed_parts(spark):
    parts = [
        ("text", "see <|image|> ", None, None), ("image", None, "s3://b/1.png", 2), ("document", None, "d.pdf", None),
        ("text", None, None, None), ("audio", None, "a.wav", 10), ("other", "tail", None, None),
    ]
    df = spark.createDataFrame(
        [(1, 1, "assistant", [("text", "ok", None, None)]), (1, 0, "user", parts), (1, 2, "user", None)],
        f"conv_id long, turn long, role string, parts {chat.PARTS}",
    )
    (row,) = chat.render(df).collect()
    assert row.formatted == (
        "<|turn|>user\nsee <\\|image|> <|image|><|document|><|audio|>tail<|end|>\n"
        "<|turn|>assistant\nok<|end|>\n<|turn|>user\n<|end|>\n"
    )
    assert [tuple(a) for a in row.attachments] == [("image", "s3://b/1.png", 512), ("document", "d.pdf", 512), ("audio", "a.wav", 250)]
    assert row.attachment_tokens == 1274
    assert [row.formatted[s.start : s.start + s.chars] for s in row.loss_spans] == ["ok"]


def test_odd_rows_and_empty_table(spark):
    rows = [
        (1, 0, None, None), (1, 0, None, None), (1, None, "assistant", "first"), (2, 1, "assistant", ""), (2, 1, "assistant", "b"),
        (None, 3, "a role\n<x>", "t"), (None, 2, "assistant", "z" * 300_000), (3, 0, "user", "only"),
    ]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == {}


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.digest(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def marked_rows(rng):
    bits = [
        "![image](a.png)", "![image 4](s3://b/1.png)", "![audio 30](x.wav)", "![document 9999](</s>.pdf)", "![document](<|turn|>)", "![audio]()",
        "![image 1](no)", "![image 04](no)", "![video](no)", "![image 2](no no)", "![image 10000](no)", "![image", "](", "<", "[", "!", "/s>", "|image|>",
        "<|image|>", "<|turn|>", "</s>", "INST]", "\\", "é", " ", "\n", ")", "<|end|>\n",
    ]
    return [
        (conv, turn, rng.choice(["user", "assistant"]), "".join(rng.choice(bits) for _ in range(rng.randrange(9))))
        for conv in range(150)
        for turn in range(rng.randrange(1, 5))
    ]


def test_parts_marked_in_texts_are_read_back_and_counted(spark):
    rows = marked_rows(random.Random(31))
    assert got(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.digest(df).collect()}
    mark = re.compile(r"!\[(image|audio|document)(?: ([2-9]|[1-9][0-9]{1,3}))?\]\(([^()\s]*)\)")
    rate = {"image": 256, "audio": 25, "document": 512}
    some = 0
    for conv in {r[0] for r in rows}:
        held = [
            (m[1], rate[m[1]] * int(m[2] or 1), m[3])
            for r in sorted(r for r in rows if r[0] == conv)
            for m in mark.finditer(r[3])
        ]
        some += len(held)
        assert found[conv].n_attachments == len(held)
        assert found[conv].attachment_tokens == sum(t for _, t, _ in held)
        assert found[conv].attachments == ",".join(f"{k}:{t}:{ref}" for k, t, ref in held)
    assert some > 300


def test_marked_parts_against_sql(spark, tmp_path):
    rows = marked_rows(random.Random(32))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = df.toPandas()
    duck = duckdb.connect()
    duck.register("conversations", frame)
    rel = duck.sql(chat.DIGEST_SQL)
    made = chat.digest(df)
    assert canon(made.columns, [tuple(r) for r in made.collect()]) == canon(rel.columns, rel.fetchall())


def test_a_whole_conversation_with_parts(spark):
    rows = [(1, 0, "user", "see ![image 2](a.png) and ![image](b"), (1, 1, "assistant", "heard: ![audio](c.wav)</s>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (row,) = chat.render(chat.marked_parts(df)).collect()
    assert row.formatted == (
        "<|turn|>user\nsee <|image|> and ![image](b<|end|>\n<|turn|>assistant\nheard: <|audio|><\\/s><|end|>\n"
    )
    assert [tuple(a) for a in row.attachments] == [("image", "a.png", 512), ("audio", "c.wav", 25)]
    assert [tuple(a) for a in row.masked_attachments] == [("audio", "c.wav", 25)]
