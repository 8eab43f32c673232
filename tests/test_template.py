import pytest
from pyspark.sql import functions as F

from weir.functions import messages as M
from weir.functions.template import ProgramTemplate, TemplateError, pieces

TALKS = [
    [("system", " be kind "), ("user", "hi "), ("assistant", "yo"), ("user", "q")],
    [("user", "only\n")],
    [],
    [("user", None), ("assistant", "a b")],
]


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TALKS)], f"id int, messages {M.DDL}")


def rendered(talks, source, generation=False, **names):
    t = ProgramTemplate(source, **names)
    return [r[0] for r in talks.orderBy("id").select(t.render(F.col("messages"), generation)).collect()]


def test_white_space():
    assert pieces("a\n  {% if x %}\n  b {%- endif -%}\n c\n") == [("text", "a\n"), ("do", "if x"), ("text", "  b"), ("do", "endif"), ("text", "c")]
    assert pieces("{# don't {{ x }} #}\n{{- 'a %} }} b' -}}  y") == [("print", "'a %} }} b'"), ("text", "y")]
    assert pieces(" {%+ if x +%}\n{% endif %}") == [("text", " "), ("do", "if x"), ("text", "\n"), ("do", "endif")]
    assert pieces("{{ x }}\n\n") == [("print", "x"), ("text", "\n")]


def test_loop_and_conditions(talks):
    src = "{{ bos_token }}{% for m in messages %}\n  {% if m.role == 'user' and not loop.first %}U{{ loop.index }}{% elif m['role'] in ['system'] %}S{% else %}-{% endif %}\n{% if loop.last %}!{{ loop.length }}{% endif %}\n{% endfor %}"
    assert rendered(talks, src, bos="B") == ["BSU2-U4!4", "B-!1", "B", "B--!2"]


def test_generation_and_known_names(talks):
    src = "{% if add_generation_prompt is defined and add_generation_prompt %}G{% endif %}{% if tools is defined %}T{% endif %}{{ name | default('none') | upper }}"
    assert rendered(talks, src) == ["NONE"] * 4 and rendered(talks, src, True, name="x") == ["GX"] * 4


def test_set_and_choices(talks):
    src = (
        "{% if messages[0]['role'] == 'system' %}{% set sys = messages[0].content | trim %}{% set rest = messages[1:] %}{% else %}{% set sys = false %}{% set rest = messages %}{% endif %}"
        "{% for m in rest %}{% set c = m.content.strip() %}{{ (sys ~ '/' ~ c) if loop.index0 == 0 and sys != false else c }};{% endfor %}{{ rest | length }}{{ c is defined }}"
    )
    assert rendered(talks, src) == ["be kind/hi;yo;q;3False", "only;1False", "0False", ";a b;2False"]


def test_expressions(talks):
    one = lambda e: rendered(talks, "{{ " + e + " }}")[0]
    assert one("1 + 2 * 3 - 4 // 3 % 2") == "6" and one("'a' + 'b' ~ 1") == "ab1" and one("'x' if 1 > 2 else 'y'") == "y"
    assert one("messages | length % 3 == 1") == "True" and one("messages[-1].role[:2] ~ messages[-1].role[-1:]") == "usr"
    assert one("messages[1].content.split(' ')[0].upper() + messages[2]['content'].replace('y', 'Y')") == "HIYo"
    assert one("messages[0].content | trim | capitalize") == "Be kind" and one("'be' in messages[0].content and 'zz' not in messages[0].content") == "True"
    assert one("messages[9].content is none") == "True" and one("messages[0].tool_calls is defined") == "False" and one("(missing or 'q') ~ none") == "qNone"
    assert one("messages[1].content.startswith('h') and messages[1].content.endswith(' ')") == "True" and one("-1 + (messages | length)") == "3"
    assert one("messages[:-1] | length") == "3" and one("messages[-2:] | length") == "2" and one("(messages + messages) | length") == "8"
    assert one("messages[0].role == none") == "False" and one("not messages") == "False" and one("loop is defined") == "False"


def test_filtered_loop_neighbours_and_else(talks):
    src = "{% for m in messages if m.role != 'system' %}{% if loop.previtem is defined and loop.previtem.role == m.role %}={% endif %}{{ m.role }}{{ ',' if not loop.last }}{% else %}nobody{% endfor %}"
    assert rendered(talks, src) == ["user,assistant,user", "user", "nobody", "user,assistant"]
    assert rendered(talks, "{% for x in ['a', 'b'] %}{{ x }}{{ loop.index }}{% endfor %}") == ["a1b2"] * 4


def test_refusal_is_an_error_of_the_row(spark, talks):
    src = "{% for m in messages %}{% if m.role == 'tool' %}{{ raise_exception('no ' + m.role) }}{% endif %}x{% endfor %}"
    assert rendered(talks, src)[0] == "xxxx"
    with pytest.raises(Exception, match="no tool"):
        rendered(spark.createDataFrame([(1, [("tool", "t")])], f"id int, messages {M.DDL}"), src)


@pytest.mark.parametrize("bad", ["{% macro x() %}{% endmacro %}", "{{ a | tojson }}", "{% for m in messages %}", "{% endif %}", "{{ 'a' b }}", "{% set ns.x = 1 %}", "{{ x.pop() }}", "{{ ( }}", "{% if x %}{% endfor %}"])
def test_unknown_parts_are_refused(bad):
    with pytest.raises(TemplateError):
        ProgramTemplate(bad)


@pytest.mark.parametrize("bad", ["{{ messages + 1 }}", "{{ messages }}", "{% for x in 3 %}{% endfor %}", "{{ messages < 'a' }}", "{{ foo() }}"])
def test_wrong_kinds_are_refused(talks, bad):
    with pytest.raises(TemplateError):
        rendered(talks, bad)


def test_same_as_the_table_of_roles(talks):
    src = "{% for m in messages %}{% if m.role in ['system', 'user', 'assistant'] %}{{ '<|' + m.role + '|>\\n' + m.content + eos_token + '\\n' }}{% endif %}{% endfor %}{% if add_generation_prompt %}{{ '<|assistant|>\\n' }}{% endif %}"
    some = talks.where("id < 3")
    for task in ("sft", "generation"):
        a, b = (M.render_chat(some, task, t).orderBy("id").collect() for t in (M.ZEPHYR, ProgramTemplate(src)))
        assert [r.text for r in a] == [r.text for r in b]
    pairs = some.where("id = 0").withColumns({"chosen": F.col("messages"), "rejected": F.slice("messages", 1, 3)})
    for task in ("rm", "dpo", "orpo"):
        assert M.render_chat(pairs, task, ProgramTemplate(src)).collect() == M.render_chat(pairs, task).collect()
