import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from weir.functions import messages as M
from weir.functions import text as X

SPACES = [chr(i) for i in range(0x3001) if chr(i).isspace()]


def strings(n=1500, seed=0):
    rnd = random.Random(seed)
    chars = list("abé\r\n:") + SPACES + ["\r\n", "\x0b", "\x1c", "ß", "user:", "assistant:"]
    return ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 12))) for _ in range(n)]


def plain_parse(text, user, assistant, drop):
    out, role, content = [], None, ""

    def close():
        if role and content.strip():
            out.append((role, content.strip()))

    for line in text.splitlines(keepends=True):
        for r, mark in (("user", user), ("assistant", assistant)):
            if line.startswith(mark):
                close()
                role, content = r, line[len(mark) :]
                break
        else:
            content += line
    close()
    return out[:-1] if out and drop and out[-1][0] != "assistant" else out


def test_strings_match_python(spark):
    rows = strings()
    df = spark.createDataFrame([(s,) for s in rows], "s string")
    c = F.col("s")
    got = df.select("s", X.normalize_ws(c).alias("n"), X.strip(c).alias("t"), X.token_count(c).alias("k"), X.split_lines(c).alias("l")).collect()
    for r in got:
        assert (r.n, r.t, r.k, r.l) == (" ".join(r.s.split()), r.s.strip(), len(r.s.split()), r.s.splitlines(keepends=True))


@pytest.mark.parametrize("drop", [True, False])
def test_parser_matches_python(spark, drop):
    rows = strings(800, 3) + ["intro\nuser: a\nb\n\nassistant: c\nuser: d", ""]
    df = spark.createDataFrame([(s,) for s in rows], "s string").select("s", M.parse_conversation(F.col("s"), drop_last=drop).alias("m"))
    for r in df.collect():
        assert [(m.role, m.content) for m in r.m] == plain_parse(r.s, "user:", "assistant:", drop)


def test_three_turns(spark):
    text = "gebruiker: Hallo\nassistent: Dag\n\ngebruiker: En nu?"
    df = spark.createDataFrame([(text,)], "s string")
    sizes = [df.select(F.size(M.parse_conversation(F.col("s"), "gebruiker:", "assistent:", d))).first()[0] for d in (True, False)]
    assert sizes == [2, 3]


def test_roman(spark):
    """Every letter and mark of Unicode that Python knows, and with it all scripts that are newer than Java's tables."""
    chars = [chr(i) for i in range(0x20, 0x32400) if not 0xD800 <= i < 0xE000 and unicodedata.category(chr(i))[0] in "LMNPS"]
    df = spark.createDataFrame([(c,) for c in chars], "c string").select("c", X.is_roman(F.concat(F.lit("a "), "c")).alias("r"))
    want = {c: not c.isalpha() or "LATIN" in unicodedata.name(c, "") for c in chars}
    assert [f"{ord(r.c):X}" for r in df.collect() if r.r != want[r.c]] == []


def test_templates():
    assert X.fill_languages("{{x}}") == "{{x}}"
    assert X.fill_languages("a {tgt_lang}", None, "Dutch") == "a Dutch"
    with pytest.raises(ValueError):
        X.check_languages("{src_lang}", None, "x")
    with pytest.raises(ValueError):
        X.check_ids("user:", "user:", "assistant:")
    with pytest.raises(KeyError):
        X.fill_columns("{other}", {})
    with pytest.raises(ValueError):
        M.answer_prompt(F.lit("a"), F.lit("b"), "c")


def test_resolve_text(tmp_path):
    f = tmp_path / "p.txt"
    f.write_text("é")
    assert X.resolve_text(str(f)) == "é" and X.resolve_text("x" * 5000) == "x" * 5000


def test_render_tasks(spark):
    m = [("user", "q"), ("assistant", "a")]
    df = spark.createDataFrame([(m, m[:1] + [("assistant", "b")])], f"chosen {M.DDL}, rejected {M.DDL}")
    r = M.render_chat(df, "dpo").first()
    assert r.text_prompt.startswith("<|system|>") and r.text_chosen == "<|assistant|>\na</s>\n" and r.text_rejected == "<|assistant|>\nb</s>\n"
    kept = M.render_chat(df.withColumn("prompt", F.slice("chosen", 1, 1)), "dpo").first()
    assert kept.text_chosen == "<|user|>\nq</s>\n<|assistant|>\na</s>\n"
    assert M.render_chat(df, "rm").first().text_rejected.startswith("<|system|>\n</s>\n<|user|>")
    with pytest.raises(ValueError):
        M.render_chat(df, "other")
    with pytest.raises(ValueError):
        M.render_chat(df.drop("rejected"), "rm")


def test_filled_text_is_not_filled_again(spark):
    df = spark.createDataFrame([("{persona}", "p")], "a string, b string")
    assert df.select(X.fill_columns("{subject}-{persona}", {"subject": F.col("a"), "persona": F.col("b")})).first()[0] == "{persona}-p"


def test_roman_letters_of_all_code_points(spark):
    """The short way past characters of the first ranges changes no verdict."""
    plain = rf"[\p{{L}}&&[^{X.ROMAN_CLASS}]]|[{X.NEWER_CLASS}]"
    c = F.decode(F.encode(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')"), "UTF-8"), "UTF-8")
    df = spark.range(0x110000).where("(id < 55296 or id > 57343) and id <> 65279").select("id", F.concat(F.lit("a"), c).alias("c"))
    assert df.where(F.length("c") == 2).count() == 0x110000 - 2049
    assert df.where(~F.col("c").rlike(plain) != X.is_roman(F.col("c"))).count() == 0
    assert X.WS_BUT_SPACE != X.WS and df.where(X.strip(F.col("c")) == "a").count() == 29  # white space of Python
    assert df.where((X.normalize_ws(F.concat("c", F.lit(" \t b "), "c")) != F.trim(F.regexp_replace(F.concat("c", F.lit(" \t b "), "c"), X.WS + "+", " ")))).count() == 0
    assert df.where(X.token_count(F.concat("c", F.lit("b"))) == 2).count() == 29


def test_strip_searches_the_ends_alone(spark):
    texts = ["", " ", "a", X.WS_CHARS, X.WS_CHARS + "a b\n c" + X.WS_CHARS, "​ a", "é　", "x" + " " * 50_000 + "y", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", X.strip(F.col("t")).alias("s"))
    assert [r.s for r in got.collect()] == [t if t is None else t.strip() for t in texts]
    assert "regexp" not in got._jdf.queryExecution().optimizedPlan().toString()
