"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}                          output
    {% for x in list %} .. {% endfor %}       x, loop.index, loop.first, loop.last
    {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}
    {% set name = expression %}
    {% generation %} .. {% endgeneration %}   what the model writes; its spans form the loss mask
    {# comment #}                             and {%- .. -%} trims white space outside

Expressions: names, ``a.b`` and ``a['b']`` (mapping keys and list places
only), strings, whole numbers, true, false, none, ``not and or``, ``== != < <=
> >= in``, ``+ ~``, parentheses and the filters upper, lower, trim, length,
escape.  There are no calls, attributes of objects or imports, so a template
cannot reach anything that is not passed to it.

``compile_template`` parses the source into a syntax tree, folds expressions
and branches that are constant, joins neighbouring literal text, and turns
each node into a closure.  Rendering gives the text and the generation spans
in code points.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

#: Control strings of common chat formats, and this library's own turn marks.
CONTROLS = ("<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
            "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>",
            "<|begin_of_text|>", "<|end_of_text|>", "<start_of_turn>", "<end_of_turn>")
_CONTROL = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)", re.S)


def escape(text: str) -> str:
    """Double backslashes, then put one behind the first character of every control string."""
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    return _CONTROL.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text) if "\\" in text else text


class TemplateError(ValueError):
    pass


_TOKEN = re.compile(r"\s*(?:(?P<num>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")"
                    r"|(?P<op>==|!=|<=|>=|[-<>+~|.()\[\]=,]))", re.S)
_TAG = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
_CONSTANTS = {"true": True, "false": False, "none": None}


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


FILTERS: dict[str, Callable] = {
    "upper": lambda v: _text(v).upper(), "lower": lambda v: _text(v).lower(), "trim": lambda v: _text(v).strip(),
    "length": len, "escape": lambda v: escape(_text(v)),
}
COMPARE: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b,
}


# ---- expressions: trees are tuples (kind, ...), ("const", value) when folded

class _Expression:
    def __init__(self, source: str):
        self.source, self.tokens, at = source, [], 0
        body = source.rstrip()
        while at < len(body):
            m = _TOKEN.match(body, at)
            if not m:
                raise TemplateError(f"cannot read {body[at:at + 20]!r} in {source!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "str" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> bool:
        hit = self.peek(*values)
        self.at += hit
        return hit

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r} in {self.source!r}")

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError(f"expected a name in {self.source!r}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self):
        tree = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r} in {self.source!r}")
        return tree

    def either(self):
        tree = self.both()
        while self.take("or"):
            tree = fold(("or", tree, self.both()))
        return tree

    def both(self):
        tree = self.negated()
        while self.take("and"):
            tree = fold(("and", tree, self.negated()))
        return tree

    def negated(self):
        return fold(("not", self.negated())) if self.take("not") else self.compared()

    def compared(self):
        tree = self.joined()
        while self.peek(*COMPARE):
            op = self.tokens[self.at][1]
            self.at += 1
            tree = fold(("compare", op, tree, self.joined()))
        return tree

    def joined(self):
        tree = self.filtered()
        while self.peek("+", "~"):
            op = self.tokens[self.at][1]
            self.at += 1
            tree = fold((op, tree, self.filtered()))
        return tree

    def filtered(self):
        tree = self.reached()
        while self.take("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            tree = fold(("filter", name, tree))
        return tree

    def reached(self):
        tree = self.atom()
        while self.peek(".", "["):
            if self.take("."):
                tree = fold(("item", tree, ("const", self.name())))
            else:
                self.need("[")
                tree = fold(("item", tree, self.either()))
                self.need("]")
        return tree

    def atom(self):
        if self.take("("):
            tree = self.either()
            self.need(")")
            return tree
        if self.at >= len(self.tokens):
            raise TemplateError(f"expression ends early: {self.source!r}")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "num":
            return ("const", int(value))
        if kind == "str":
            return ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t", "r": "\r"}.get(m[1], m[1]), value[1:-1],
                                    flags=re.S))
        if kind == "name":
            return ("const", _CONSTANTS[value]) if value in _CONSTANTS else ("name", value)
        raise TemplateError(f"unexpected {value!r} in {self.source!r}")


def fold(tree):
    """The tree, as a constant where its parts are."""
    parts = [x for x in tree[1:] if isinstance(x, tuple)]
    return ("const", closure(tree)({})) if all(x[0] == "const" for x in parts) else tree


def _item(value, key):
    if isinstance(value, dict):
        return value.get(key)
    if isinstance(value, (list, tuple)) and isinstance(key, int) and -len(value) <= key < len(value):
        return value[key]
    return None


def closure(tree) -> Callable[[dict], object]:
    """A function of the variables that gives the expression's value."""
    kind = tree[0]
    if kind == "const":
        value = tree[1]
        return lambda v: value
    if kind == "name":
        name = tree[1]
        return lambda v: v.get(name)
    if kind == "filter":
        f, a = FILTERS[tree[1]], closure(tree[2])
        return lambda v: f(a(v))
    if kind == "compare":
        f, a, b = COMPARE[tree[1]], closure(tree[2]), closure(tree[3])
        return lambda v: f(a(v), b(v))
    if kind == "not":
        a = closure(tree[1])
        return lambda v: not a(v)
    a, b = closure(tree[1]), closure(tree[2])
    if kind == "or":
        return lambda v: a(v) or b(v)
    if kind == "and":
        return lambda v: a(v) and b(v)
    if kind == "+":
        return lambda v: a(v) + b(v)
    if kind == "~":
        return lambda v: _text(a(v)) + _text(b(v))
    return lambda v: _item(a(v), b(v))


# ---- statements

class _Parser:
    def __init__(self, source: str):
        self.parts, trim = [], False
        for k, part in enumerate(_TAG.split(source)):
            if k % 2 == 0:
                text = part.lstrip() if trim else part
                if text:
                    self.parts.append(("text", text))
                trim = False
                continue
            kind, body = part[:2], part[2:-2]
            if kind == "{#":
                continue
            if body.startswith("-"):
                body = body[1:]
                if self.parts and self.parts[-1][0] == "text":
                    text = self.parts.pop()[1].rstrip()
                    if text:
                        self.parts.append(("text", text))
            trim = body.endswith("-")
            self.parts.append((kind, (body[:-1] if trim else body).strip()))
        self.at = 0

    def block(self, *ends: str) -> tuple[list, str, str]:
        """(nodes, tag that ended the block, the tag's rest)."""
        nodes: list = []
        while self.at < len(self.parts):
            kind, body = self.parts[self.at]
            self.at += 1
            if kind == "text":
                nodes.append(("text", body))
            elif kind == "{{":
                tree = _Expression(body).whole()
                nodes.append(("text", _text(tree[1])) if tree[0] == "const" else ("out", tree))
            else:
                word, _, rest = body.partition(" ")
                if word in ends:
                    return nodes, word, rest
                nodes.extend(self.statement(word, rest))
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return nodes, "", ""

    def statement(self, word: str, rest: str) -> list:
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"cannot read for {rest!r}")
            body = self.block("endfor")[0]
            return [("for", m[1], _Expression(m[2]).whole(), body)]
        if word == "if":
            branches, otherwise = [], []
            while True:
                test = _Expression(rest).whole()
                body, end, rest = self.block("elif", "else", "endif")
                branches.append((test, body))
                if end == "else":
                    otherwise = self.block("endif")[0]
                if end != "elif":
                    break
            live = []
            for test, body in branches:  # constant tests choose now
                if test[0] == "const":
                    if test[1]:
                        otherwise = body
                        break
                    continue
                live.append((test, body))
            return [("if", live, otherwise)] if live else otherwise
        if word == "set":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(?!=)(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"cannot read set {rest!r}")
            return [("set", m[1], _Expression(m[2]).whole())]
        if word == "generation":
            return [("generation", self.block("endgeneration")[0])]
        raise TemplateError(f"unknown tag {word!r}")


class _Sink:
    """Text written so far, its length, and generation spans."""

    __slots__ = ("length", "parts", "spans")

    def __init__(self):
        self.parts, self.length, self.spans = [], 0, []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _steps(nodes: list) -> Callable[[dict, _Sink], None]:
    """One closure for a block; neighbouring texts are one write."""
    joined: list = []
    for node in nodes:
        if node[0] == "text" and joined and joined[-1][0] == "text":
            joined[-1] = ("text", joined[-1][1] + node[1])
        else:
            joined.append(node)
    steps = [_step(n) for n in joined]

    def run(v, sink):
        for s in steps:
            s(v, sink)

    return steps[0] if len(steps) == 1 else run


def _step(node) -> Callable[[dict, _Sink], None]:
    kind = node[0]
    if kind == "text":
        text = node[1]
        return lambda v, sink: sink.write(text)
    if kind == "out":
        value = closure(node[1])
        return lambda v, sink: sink.write(_text(value(v)))
    if kind == "set":
        name, value = node[1], closure(node[2])

        def assign(v, sink):
            v[name] = value(v)

        return assign
    if kind == "generation":
        body = _steps(node[1])

        def generate(v, sink):
            start = sink.length
            body(v, sink)
            sink.spans.append((start, sink.length))

        return generate
    if kind == "if":
        branches = [(closure(t), _steps(b)) for t, b in node[1]]
        otherwise = _steps(node[2])

        def choose(v, sink):
            for test, body in branches:
                if test(v):
                    return body(v, sink)
            return otherwise(v, sink)

        return choose
    name, items, body = node[1], closure(node[2]), _steps(node[3])

    def loop(v, sink):
        seen = list(items(v) or ())
        for k, x in enumerate(seen):
            inner = dict(v)
            inner[name] = x
            inner["loop"] = {"index": k + 1, "first": k == 0, "last": k + 1 == len(seen)}
            body(inner, sink)

    return loop


def compile_template(source: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """variables -> (text, generation spans in code points)."""
    body = _steps(_Parser(source).block()[0])

    def render(variables: dict):
        sink = _Sink()
        body(dict(variables), sink)
        return "".join(sink.parts), sink.spans

    return render


def read_turns(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end of the escaped text) of every turn of the default template's output."""
    out, at = [], 0
    while at < len(text):
        if not text.startswith("<|turn|>", at):
            raise TemplateError(f"no turn at {at}")
        middle = text.index("<|text|>", at)
        end = text.index("<|end|>", middle)
        out.append((unescape(text[at + 8:middle]), unescape(text[middle + 8:end]), middle + 8, end))
        at = end + 8  # the mark and a line feed
    return out


#: Marks turns, escapes texts, and puts what assistants say under the loss mask.
DEFAULT = ("{% for m in messages -%}<|turn|>{{ m.role | escape }}<|text|>"
           "{%- if m.role == 'assistant' -%}{% generation %}{{ m.text | escape }}{% endgeneration %}"
           "{%- else -%}{{ m.text | escape }}{%- endif -%}<|end|>{{ '\\n' }}{%- endfor %}")

__all__: Iterable[str] = ("CONTROLS", "DEFAULT", "TemplateError", "compile_template", "escape", "read_turns", "unescape")
