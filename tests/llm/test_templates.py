"""The template language: parsing, folding, rendering, and what it keeps out."""

import pytest

from tidemark.llm.chat import CONTROLS, escaper, read_turns, unescape
from tidemark.llm.templates import Template, TemplateError


@pytest.mark.parametrize(
    "source, wanted",
    [
        ("a{{ 1 + 2 * 3 }}b", "a7b"),
        ("{{ 'x' ~ 1 ~ none }}", "x1"),
        ("{% if n > 2 and not off %}big{% elif n == 2 %}two{% else %}small{% endif %}", "big"),
        ("{% for x in xs %}{{ loop.index }}:{{ x }}{% if not loop.last %},{% endif %}{% endfor %}", "1:a,2:b"),
        ("  {%- set y = xs[0] | upper -%}  {{ y }}", "A"),
        ("{{ m.role }}{{ m['role'] }}{{ m.absent }}{{ nothing.at.all }}", "useruser"),
        ("{{ 'b' in xs }} {{ 'z' not in xs }} {{ xs | length }}", "True True 2"),
        ("{{ 'yes' if n == 3 else 'no' }}{# a remark #}", "yes"),
        ("{{ '\\n\\'' }}", "\n'"),
    ],
)
def test_rendering(source, wanted):
    text, spans = Template(source).render(n=3, off=False, xs=["a", "b"], m={"role": "user"})
    assert (text, spans) == (wanted, [])


def test_constants_are_folded():
    assert Template("a{{ 1 + 1 }}{% if true %}b{% else %}{{ x }}{% endif %}{% if 1 == 2 %}{{ y }}{% endif %}c").tree == [("text", "a2bc")]


def test_generations_are_marked():
    text, spans = Template("<{% for x in xs %}{% generation %}{{ x }}{% endgeneration %};{% endfor %}>").render(xs=["ab", "", "c"])
    assert text == "<ab;;c;>" and spans == [(1, 3), (5, 6)]


@pytest.mark.parametrize(
    "source",
    ["{{ x", "{% if x %}", "{% endfor %}", "{% import os %}", "{{ x | nosuch }}", "{{ }}", "{{ a b }}", "{% for 1 in x %}{% endfor %}", "{{ 1 + 'a' }}", "{{ x() }}"],
)
def test_wrong_templates_are_refused(source):
    with pytest.raises(TemplateError):
        Template(source).render(x=1)


def test_nothing_but_the_variables_is_reached():
    text, _ = Template("{{ x.__class__ }}{{ x['__class__'] }}{{ x.real }}{{ open }}").render(x="s")
    assert text == ""


@pytest.mark.parametrize("text", ["", "\\", "</s>", "[INST]\\[/INST]", "\\\\</s>\\", "[\\INST]", "<s><s>", "<<SYS>>", "[ANSWER", "["])
def test_escapes_are_reversed_and_hold_no_control(text):
    escaped = escaper(CONTROLS)(text)
    assert unescape(escaped) == text and not any(c in escaped for c in CONTROLS)
    assert read_turns(f"<s>[INST] {escaped} [/INST][ANSWER]{escaped}</s>") == [("user", text), ("assistant", text)]
