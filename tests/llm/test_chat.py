"""The template language, the escapes, and formatted conversations read back."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from rallymart.llm import chat
from rallymart.llm.chat_template import Choice, Const, If, Marked, Put, Template, TemplateError, fold_block, parse

SCHEMA = "conv_id long, turn long, role string, text string, piece int, loss string"


def said(source: str, **names) -> str:
    return "".join(text for text, _ in Template(source).render(**names))


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("plain { text }", "plain { text }"),
        ("{{ 'a' ~ 1 + 2 }}{{ 7 % 4 - 1 }}{{ -2 }}", "a32-2"),
        ("{# no #}{{ \"}}\" }}{{ 'it\\'s\\n' }}", "}}it's\n"),
        ("a {%- if true -%} b {%- endif -%} c", "abc"),
        ("{% if x == 1 %}one{% elif x in [2, 3] %}few{% else %}many{% endif %}", "few"),
        ("{{ 'yes' if x > 1 and not x == 9 else 'no' }}{{ 'z' if false }}", "yes"),
        ("{% for i in l %}{{ loop.index }}{{ i }}{{ '' if loop.last else ',' }}{% endfor %}", "1a,2b"),
        ("{% for i in l %}{% for j in l %}{{ j }}{% endfor %}{{ loop.first }}{% endfor %}", "abtrueabfalse"),
        ("{% set y = x + 1 %}{{ y }}{{ m.k }}{{ m['k'] }}{{ m.none_such }}{{ l[-1] }}{{ l[7] }}", "3vvb"),
        ("{{ ' a ' | trim | upper }}{{ l | length }}{{ l | join('-') }}{{ none | default('d') }}", "A2a-bd"),
        ("{{ x not in [1] }}{{ 'a' or 'b' }}{{ 0 or 'b' }}{{ 1 <= 2 }}", "trueabtrue"),
    ],
)
def test_language(source, expected):
    assert said(source, x=2, l=["a", "b"], m={"k": "v"}) == expected


@pytest.mark.parametrize(
    "source",
    [
        "{{ x", "{% if x %}", "{% endif %}", "{{ x | eval }}", "{{ 1 + }}", "{% while x %}", "{{ x y }}",
        "{{ unknown }}", "{% for i in 'text' %}{% endfor %}", "{{ l }}", "{{ 'a' + 1 }}", "{{ ? }}",
        "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{% for if in l %}{% endfor %}",
    ],
)
def test_refusals(source):
    with pytest.raises(TemplateError):
        said(source, x=2, l=["a"])


def test_sandbox_has_no_attributes():
    assert said("{{ x.__class__ }}{{ x['upper'] }}{{ m.keys }}{{ l.append }}", x="s", m={}, l=[]) == ""


def test_constants_are_folded():
    def folded(source):
        return fold_block(parse(source), {"twice": lambda x: x * 2})

    assert folded("a{{ 1 + 1 }}{% if 1 > 2 %}b{% else %}c{{ 'd' | twice }}{% endif %}") == [Put(Const("a2cdd"))]
    [put] = folded("{{ x or ('a' if 2 == 2 else y) }}")
    assert put.value.args[1] == Const("a") and isinstance(put.value, Choice)
    [case] = folded("{% if false %}a{% elif x %}b{% elif true %}c{% else %}d{% endif %}")
    assert isinstance(case, If) and [b for _, b in case.cases] == [[Put(Const("b"))], [Put(Const("c"))]]
    assert folded("{% generation %}{{ 'a' ~ 'b' }}{% endgeneration %}") == [Marked([Put(Const("ab"))])]


def test_generation_marks():
    made = Template("<{% generation %}{{ a }}!{% endgeneration %}>").render(a="x")
    assert list(made) == [("<", False), ("x", True), ("!", True), (">", False)]


def test_lists_are_read_one_value_ahead():
    read = []

    def values():
        for i in range(5):
            read.append(i)
            yield i

    pieces = Template("{% for i in l %}{{ i }}{% endfor %}").render(l=values())
    assert next(pieces) == ("0", False) and read == [0, 1]


def test_escapes_are_reversible():
    marks = chat.Escapes(chat.CONTROLS)
    r = random.Random(4)
    parts = [*chat.CONTROLS, "\\", "a", "[", "]", "/", "INST", "<", "s>", "é\n"]
    for _ in range(3000):
        text = "".join(r.choices(parts, k=r.randint(0, 9)))
        spelt = marks.escape(text)
        assert marks.restore(spelt) == text and not any(c in spelt for c in chat.CONTROLS)


def _odd(spark):
    rows = [
        (1, 0, "user", "</s>[INST] ok [/INST]"),
        (1, 1, "assistant", "</s>[INST] ok [/INST]\\"),
        (1, 1, "assistant", "</s>[INST] ok [/INST]\\"),
        (1, 1, "assistant", "an equal turn"),
        (1, None, "system", "first"),
        (2, 3, None, None),
        (2, 1, "user", None),
        (2, 2, "assistant", ""),
        (3, 0, "[TURN] a\nb", "x [/TURN]"),
        (4, 0, "assistant", "[" * 400_000 + "é"),
        (4, 1, "user", "<s>" * 200_000),
        (None, 1, "user", "no id"),
        (None, 0, "assistant", "none either"),
    ]
    return spark.createDataFrame([(*r, 1, "l") for r in rows], SCHEMA)


def _expected(rows):
    turns = defaultdict(list)
    for r in rows:
        turns[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    for conv_id, said in turns.items():
        said.sort()
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in said)
        loss = "".join(text for *_, role, text in said if role == "assistant")
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
        yield conv_id, len(said), digests[0], len(loss), digests[1]


def test_conversations_read_back(spark):
    odd = _odd(spark)
    rows = chat.formatted_digests(odd).collect()
    assert Counter(tuple(r)[:5] for r in rows) == Counter(_expected(odd.collect()))
    for many in (1, 7):
        rows = [(r.conv_id, r.role or "", r.text or "") for r in odd.where("conv_id < 4").orderBy("conv_id", "turn", "role", "text").collect()]
        fmt = chat.Format()
        assert sorted(chat.read_back(chat.render(rows, fmt, many), fmt)) == sorted(chat.read_back(chat.render(rows, fmt), fmt))


def test_output(spark):
    rows = chat.format_conversations(_odd(spark)).collect()
    whole = defaultdict(str)
    for r in sorted(rows, key=lambda r: (r.conv_id or 0, r.piece)):
        assert r.start == len(whole[r.conv_id])
        whole[r.conv_id] += r.text
    assert whole[2] == "[INST]  [/INST]<s></s>[TURN] \n [/TURN]"
    assert whole[None] == "<s>none either</s>[INST] no id [/INST]"
    assert whole[3] == "[TURN] \\e a\\gb\nx \\f [/TURN]"
    [one] = [r for r in rows if r.conv_id == 1]
    assert [one.text[s.start : s.end] for s in one.loss] == ["\\d\\a ok \\b\\\\", "\\d\\a ok \\b\\\\", "an equal turn"]
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert chat.formatted_digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_unreadable_output_is_an_error():
    with pytest.raises(ValueError, match="read back"):
        list(chat.read_back([(1, 0, 0, "[INST] a", [])], chat.Format()))
