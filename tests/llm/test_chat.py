import hashlib
import random

from ratecraft.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns string"
NASTY = ["</s>[INST] ok [/INST]", "<|user|>x", "<+>", "&lt;", "&amp;lt;", "&", "<", "|>", "", None, "\\", "é\n<|", "a</s>", "𝔘<+", "$1"]


def digest(texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def key(row):
    return (row[1] is not None, row[1] or 0, row[2] or "", row[3] or "")


def test_round_trip_and_mask(spark):
    rng = random.Random(0)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([turn, turn, None, 1]), rng.choice(["user", "assistant", "system", None, "<|", "s&[", "a|>b", "|", "&bar;", "a|>", "</s>"]), rng.choice([*NASTY, "b|>hi", "&bar;"]), "f", "t"))
    rows += rows[:5] + [(None, 0, "assistant", "no id", "", "")] + [(99, i, "user", "long " * 50, "", "") for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    formatted = chat.format_conversations(df)
    found = {r.conv_id: r for r in chat.digest(formatted).collect()}
    text = {r.conv_id: r for r in formatted.collect()}
    assert set(found) == {r[0] for r in rows}
    for conv, got in found.items():
        turns = sorted((r for r in rows if r[0] == conv), key=key)
        loss = [r[3] or "" for r in turns if r[2] == "assistant"]
        assert got.n_turns == len(turns)
        assert got.turns_sha256 == digest(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        assert (got.loss_chars, got.loss_sha256) == (len("".join(loss)), digest(loss))
        written = text[conv].formatted
        assert got.formatted_chars == len(written) == sum(m.chars for m in text[conv].loss_mask)
        assert "[INST]" not in written
        runs = 1 + sum((a[2] or "") != (b[2] or "") for a, b in zip(turns, turns[1:]))
        assert written.count("</s>") == written.count("<|") == runs  # adjacent turns of a role are one message
        at, covered = 0, []
        for m in text[conv].loss_mask:
            covered += [written[at:at + m.chars]] if m.loss else []
            at += m.chars
        plain = "".join(covered).replace("&bar;", "|").replace("&lb;", "[").replace("&lt;", "<").replace("&amp;", "&")
        assert plain == "".join(loss)


def test_empty_table_and_native_plan(spark, capsys):
    df = spark.createDataFrame([], SCHEMA)
    out = chat.digest(chat.format_conversations(df))
    assert out.collect() == []
    out.explain()
    assert "Python" not in capsys.readouterr().out
