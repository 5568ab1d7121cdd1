import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfpulse.llm.chat import (
    CHAT,
    CHAT_FILTERS,
    Reader,
    conversation_digests,
    escape,
    escape_line,
    format_conversations,
    unescape,
)
from shelfpulse.llm.template import Const, Emit, Template, TemplateError

ROWS = "conv_id long, turn long, role string, text string, messages string, n_turns int"


def shown(source, **values):
    return Template(source).render(values)[0]


def test_language():
    assert shown("{{ a.b }}{{ a['b'] }}{{ a.c }}", a={"b": "x"}) == "xx"
    assert shown("{% for x in xs %}{{ loop.index }}{{ x }}{% if not loop.last %},{% endif %}{% endfor %}",
                 xs=["p", "q"]) == "1p,2q"
    assert shown("{% if a == 'y' %}1{% elif a in 'xyz' %}2{% else %}3{% endif %}", a="z") == "2"
    assert shown("{{ 'p' if a else 'q' }}{{ a ~ 1 }}", a="") == "q1"
    assert shown("a  {{- ' b' -}}  c") == "a bc"
    assert shown("{% set x = a | trim | upper %}{{ x }}", a=" hi ") == "HI"
    assert Template("x{% generation %}y{{ a }}{% endgeneration %}z").render({"a": "b"}) == ("xybz", [(1, 3)])


def test_constants_are_folded():
    folded = Template("a{{ 'b' ~ 1 }}{% if 1 < 2 and true %}c{% else %}{{ d }}{% endif %}{{ 'E' | lower }}")
    assert folded.tree == (Emit(Const("ab1ce")),)


@pytest.mark.parametrize(
    "source",
    ["{{ a.__class__() }}", "{{ a", "{% if a %}", "{% endfor %}", "{{ a | nothing }}", "{{ 'a' - 1 }}",
     "{% import os %}", "{{ }}", "{{ a %}", "{{ a b }}"],
)
def test_bad_templates(source):
    with pytest.raises(TemplateError):
        Template(source)


def test_objects_are_out_of_reach():
    assert shown("{{ a.__class__ }}{{ a.upper }}", a="text") == ""
    with pytest.raises(TemplateError):
        shown("{% for x in a %}{% endfor %}", a="text")


TEXT = st.text(st.sampled_from("ab<|>\\n\n /[]é turnend"), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb", "<|turn|>"]), TEXT), max_size=5))
def test_reading_back(turns):
    import hashlib

    reader = Reader()
    messages = [{"role": r, "text": t} for r, t in turns]
    template = Template(CHAT, CHAT_FILTERS)
    template.stream({"messages": messages}, reader.take)
    n, turn_hash, loss, loss_hash, chars = reader.finish()
    assert n == len(turns)
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    spoken = "".join(t for r, t in turns if r == "assistant")
    assert turn_hash == hashlib.sha256(whole.encode()).hexdigest()
    assert (loss, loss_hash) == (len(spoken), hashlib.sha256(spoken.encode()).hexdigest())
    text, spans = template.render({"messages": messages})
    assert chars == len(text)
    assert "".join(unescape(text[a:b]) for a, b in spans) == spoken
    assert all(unescape(escape(t)) == t and unescape(escape_line(t)) == t for _, t in turns)


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "a"), (2, None, None, ""),
            (None, 0, "user", "x"), (1, 1, "assistant", "a"), (3, 5, "assistant", "<|end|>\n<|turn|>user\n"),
            (4, 0, "assistant", "long " * 200_000)]
    table = spark.createDataFrame([(*r, "m", 1) for r in rows], ROWS)
    got = {r["conv_id"]: r for r in conversation_digests(table).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {1: 4, 2: 1, None: 1, 3: 1, 4: 1}
    assert {k: r["loss_chars"] for k, r in got.items()} == {1: 3, 2: 0, None: 0, 3: 21, 4: 1_000_000}
    texts = {r["conv_id"]: r["text"] for r in format_conversations(table).collect()}
    assert texts[1] == (
        "<|turn|>user\n<|end|>\n" + "<|turn|>assistant\na<|end|>\n" * 2 + "<|turn|>assistant\nb<|end|>\n"
    )
    assert {k: len(v) for k, v in texts.items()} == {k: r["formatted_chars"] for k, r in got.items()}
    assert conversation_digests(table.limit(0)).count() == 0
