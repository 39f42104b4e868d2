"""A lexer and parser of assignments in source code and configuration.

One pass cuts a text into tokens, with states for strings, comments, continued lines and for what stands after an
operator, where a bare value follows other rules than a name does. A second pass over the tokens keeps a stack of
brackets and gives every literal and every name that a value is made of to the name it is assigned to. Both passes are
linear in the text: what an opening quote, comment or bracket lacks is found once.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field


@dataclass
class Assignments:
    """Of each name: the literals assigned to it, as (start, end, value), and the names that take its value."""

    literals: dict[str, list[tuple[int, int, str]]] = field(default_factory=lambda: defaultdict(list))
    flows: dict[str, set[str]] = field(default_factory=lambda: defaultdict(set))


_NAME = r"[^\W\d][\w$]*(?:(?:\.|->|::|-)[^\W\d][\w$]*)*"
_ONE_NAME = re.compile(_NAME)
#: What stands anywhere but after an operator, in order of trial.
_PLAIN = re.compile(
    rf"""(?P<space>(?:[^\S\n]|\\\r?\n)+)|(?P<line>\n)|(?P<define>\#[ \t]*define[ \t]+(?=[^\W\d]))|(?P<env>(?:(?<=\n)|\A)(?:ENV|setenv)[ \t]+(?={_NAME}[ \t]+[^\s=]))
    |(?P<flag>--(?={_NAME}[ \t]+[^\s=-]))|(?P<comment>\#|//|/\*|<!--)|(?P<variable>\$\{{?(?P<of>[^\W\d]\w*)(?P<default>:?-)?)|(?P<percent>%(?P<bat>[^\W\d]\w*)%)
    |(?P<name>{_NAME})|(?P<quote>\"\"\"|'''|["'`])|(?P<no>[=!]==?|=~|[<>]=|::|->)|(?P<set>:=|=>|<-|(?:\+|\.|\?|\|\||\?\?|&&|//)?=|:)
    |(?P<join>\+|\.\.?|&|\|\||\?\?)|(?P<open>[(\[{{])|(?P<close>[)\]}}])|(?P<tag><(?=[^\W\d]))|(?P<comma>,)|(?P<end>;)|(?P<ask>\?)|(?P<other>\d[\w.]*|.)""",
    re.VERBOSE,
)
_BLANK = re.compile(r"(?:[^\S\n]|\\\r?\n)*")
#: A bare value, and a word for the way of signing on before it.
_BARE = re.compile(r"""(?:(?i:bearer|basic|digest|token)[ \t]+(?=[^\s=:]))?(?P<bare>[^\s,;"'`#(){}\[\]]+)""")
#: What stands after an operator and is no bare value: variables, elements, comments, prefixed strings.
_NOT_BARE = re.compile(r"""\$\{?[^\W\d]|%[^\W\d]\w*%|<(?=[^\W\d/!])|//|/\*|(?P<prefix>[A-Za-z]\w?)(?=["'])""")
_BLOCK = re.compile(r"[|>][+-]?\d?[ \t]*(?:#[^\n]*)?\r?\n")
_IDENT = re.compile(r"[$@]?[^\W\d][\w.$]*")
_PARAMETER = re.compile(r"""[?&;]([^\W\d][\w.-]*)=([^&;\s"'#]+)""")
_PREFIXES = {"b", "r", "u", "f", "rb", "br", "fr", "rf", "l", "u8"}
_NEXT_PARAMETER = re.compile(r"&(?=[^\W\d][\w.-]*=)")
#: A type between a name and its value: what stands outside of brackets, and what may not stand in it.
_TYPE_RUN = re.compile(r"[^=\n:;#{}]*")
_TYPE = re.compile(r"[&*]?(?:'\w+[ \t]+)?(?:(?:mut|const)[ \t]+)?[^\W\d][\w.?*]*(?:[ \t]*[|&][ \t]*[^\W\d][\w.?*]*)*[?!]?")
_TAG = re.compile(r"<(?P<tag>[^\W\d][\w.:-]*)(?P<attributes>[^<>]*)>")
_ATTRIBUTE = re.compile(r"""([^\W\d][\w.:-]*)\s*=\s*(?:"([^"]*)"|'([^']*)')""")
_SIGN_ON = re.compile(r"(?i)(?:bearer|basic|digest|token)[ \t]+")
#: Calls whose first argument names what the others are assigned to, and calls that look up the name they are given.
SETTERS = {"setenv", "putenv", "setdefault", "define", "setproperty", "set", "put", "setattr", "setitem", "setstring", "addheader", "setheader", "append"}
GETTERS = {"get", "getenv", "env", "getproperty", "fetch", "var", "lookup", "getstring", "getattr", "environ", "config", "secret"}
#: Words between operands, and words that are none.
_BETWEEN = {"or", "and", "if", "else", "in", "unless", "xor"}
_NO_OPERAND = {"new", "await", "not", "return", "yield", "const", "static", "final", "ref", "move", "raw"}


def read_assignments(text: str) -> Assignments:
    """The assignments of a text, and of its comments and strings as texts of their own.

    In a comment, further marks of comments end a line and nothing else: so a text is read once for itself, once for its comments, and
    once more for each level of strings in strings, of which there are few, as each uses up a kind of quote.

    Names keep their last part: of `a.b->c`, it is `c`. Literals that + or mere adjacency joins are one, from the first's
    start to the last's end. Lines of a block or of a string over several lines are a literal each.
    """
    found = Assignments()
    parts = [(text, 0, False)]
    while parts:
        own, at, comment = parts.pop()
        lexer = _Lexer(own, at, found, comment)
        _parse(lexer, found)
        parts += [(own[a:b], at + a, inner) for a, b, inner in lexer.inner if "=" in own[a:b] or ":" in own[a:b]]
    return found


def last_part(name: str) -> str:
    return re.split(r"\.|->|::", name)[-1].lstrip("$@")


class _Lexer:
    """Tokens (kind, start, end, value) of a text that stands at `offset` in the whole.

    Kinds: name, string, bare, variable, set, join, open, close, comma, end, line, ask, other.
    """

    def __init__(self, text: str, offset: int, found: Assignments, comment: bool = False) -> None:
        self.text, self.offset, self.found, self.comment = text, offset, found, comment
        self.tokens: list[tuple[str, int, int, str]] = []
        self.inner: list[tuple[int, int, bool]] = []  # comments and strings, which may hold assignments, and whether they are in a comment
        self.dead: dict[str, int] = {}  # what does not close before this place
        at, after = 0, ""  # after: the operator before a value
        while at < len(text):
            at, after = (self._value(at, after), "") if after else self._plain(at)

    def _close(self, mark: str, at: int) -> int:
        """The next place of `mark`, or -1; what is not found once is not looked for again."""
        if mark in self.dead:
            return -1
        end = self.text.find(mark, at)
        if end < 0:
            self.dead[mark] = len(self.text)
        return end

    def _string(self, at: int, quote: str) -> int:
        """Takes the string whose quote stands at `at`; the place after it, or `at` if it does not close."""
        text, begin = self.text, at + len(quote)
        if len(quote) == 3 or quote == "`":
            end = self._close(quote, begin)
        else:
            if self.dead.get(quote, -1) > at:
                return at
            end = begin
            while True:
                stop = _STOPS[quote].search(text, end)
                if not stop or stop[0] == "\n":
                    self.dead[quote] = stop.start() if stop else len(text)  # no quote of its kind closes on this line
                    return at
                end = stop.start()
                if stop[0] == quote:
                    break
                end += 2
        if end < 0:
            return at
        self.tokens.append(("string", begin, end, text[begin:end]))
        if end - begin > 2:
            self.inner.append((begin, end, self.comment))
        return end + len(quote)

    def _plain(self, at: int) -> tuple[int, str]:
        text = self.text
        m = _PLAIN.match(text, at)
        kind, end = m.lastgroup, m.end()
        add = lambda kind, a, b: self.tokens.append((kind, a, b, text[a:b]))
        if kind == "name":
            if text[end : end + 1] in ('"', "'") and m[0].lower() in _PREFIXES:
                quote = text[end] * 3 if text.startswith(text[end] * 3, end) else text[end]
                if (after := self._string(end, quote)) > end:
                    return after, ""
            add("name", at, end)
        elif kind == "quote":
            if text[at] == "'" and at and (text[at - 1].isalnum() or text[at - 1] == "_"):  # an apostrophe
                return at + 1, ""
            for quote in (m[0], m[0][0]):
                if (after := self._string(at, quote)) > at:
                    return after, ""
            return at + 1, ""
        elif kind == "comment":
            return self._comment(at, m[0]), ""
        elif kind in ("define", "env", "flag"):
            name = _ONE_NAME.match(text, end)
            add("name", end, name.end())
            self.tokens.append(("set", name.end(), name.end(), "="))
            return name.end(), "="
        elif kind in ("of", "variable", "default", "bat", "percent"):
            return self._variable(m), ""
        elif kind == "set":
            if m[0] == ":" and (typed := self._typed(end)):
                end = typed
            add("set", at, end)
            before = self.tokens[-2][0] if len(self.tokens) > 1 else ""
            return end, m[0] if before in ("name", "string", "variable", "bare", "close") else ""
        elif kind == "tag":
            self._element(at)
            return at + 1, ""
        elif kind != "space":
            add({"no": "other"}.get(kind, kind), at, end)
        return end, ""

    def _variable(self, m: re.Match) -> int:
        name, end = m["of"] or m["bat"], m.end()
        self.tokens.append(("variable", m.start(), end, name))
        if m["default"]:  # ${NAME:-literal}
            close = self.text.find("}", end, self._line_end(end))
            if close >= 0:
                self.tokens += [("join", end, end, "||"), ("bare", end, close, self.text[end:close])]
                return close + 1
        return end + (self.text.startswith("${", m.start()) and self.text.startswith("}", end))

    def _line_end(self, at: int) -> int:
        end = self.text.find("\n", at)
        return len(self.text) if end < 0 else end

    def _comment(self, at: int, mark: str) -> int:
        text = self.text
        if self.comment:
            if not (mark == "//" and at and text[at - 1] == ":") and self.tokens and self.tokens[-1][0] != "line":
                self.tokens.append(("line", at, at + len(mark), mark))
            return at + len(mark)
        close = {"/*": "*/", "<!--": "-->"}.get(mark)
        if close:
            end = self._close(close, at + len(mark))
            if end < 0:
                return at + len(mark)
            self.inner.append((at + len(mark), end, True))
            return end + len(close)
        if mark == "//" and at and text[at - 1] == ":":  # of an address
            return at + 2
        end = self._line_end(at)
        self.inner.append((at + len(mark), end, True))
        return end

    def _typed(self, at: int) -> int | None:
        """The place after `=` where a type and `=` stand at `at`."""
        text, end = self.text, _TYPE_RUN.match(self.text, at).end()
        if text[end : end + 1] != "=" or text[end + 1 : end + 2] in ("=", "~", ">", ""):
            return None
        value = _BLANK.match(text, end + 1).end()
        if not text[value : value + 1].strip() or (not text[end - 1].isspace() and text[value] not in "\"'`"):
            return None
        flat, depth = [], 0
        for c in text[at:end]:
            depth += (c in "[<(") - (c in "]>)")
            if depth < 0:
                return None
            if depth == 0 and c not in "]>)":
                flat.append(c)
        return end + 1 if depth == 0 and _TYPE.fullmatch("".join(flat).strip()) else None

    def _element(self, at: int) -> None:
        """<name>value</name>, and elements whose attributes are a key and a value."""
        m = _TAG.match(self.text, at)
        if not m:
            return
        held = {a.lower(): (v if v is not None else w) for a, v, w in _ATTRIBUTE.findall(m["attributes"])} if "=" in m["attributes"] else {}
        key = held.get("key") or held.get("name") or held.get("id")
        names = [last_part(m["tag"].split(":")[-1])] + ([last_part(key)] if key else [])
        if key and "value" in held:
            for a in _ATTRIBUTE.finditer(m["attributes"]):
                if a[1].lower() == "value":
                    group = 2 if a[2] is not None else 3
                    self._literal(names[1], m.start("attributes") + a.start(group), m.start("attributes") + a.end(group))
        close = self.text.find("<", m.end())
        if close >= 0 and self.text.startswith(f"/{m['tag']}", close + 1):
            for name in names:
                self._literal(name, m.end(), close)

    def _literal(self, name: str, start: int, end: int) -> None:
        """Takes text[start:end] without the white space around it."""
        value = self.text[start:end]
        start += len(value) - len(value.lstrip())
        if value := value.strip():
            self.found.literals[name].append((self.offset + start, self.offset + start + len(value), value))

    def _value(self, at: int, operator: str) -> int:
        """What follows an operator, if it is a bare value or a block; else nothing is taken."""
        text = self.text
        at = _BLANK.match(text, at).end()
        if operator == ":" and text[at : at + 1] in ("|", ">") and (block := _BLOCK.match(text, at)):
            return self._block(block.end())
        other = _NOT_BARE.match(text, at)
        if other and (other["prefix"] or "x").lower() in {"x", *_PREFIXES}:
            return at
        m = _BARE.match(text, at)
        if not m:
            return at
        start, end = m.span("bare")
        if more := _NEXT_PARAMETER.search(text, start, end):
            end = more.start()
        bare, following = text[start:end], text[end : end + 1]
        tail = ""
        if following in ('"', "'", "`", "(", "[") and following:
            while bare and bare[-1] in "+&=.":
                bare, tail = bare[:-1], bare[-1] + tail
        if bare:
            self.tokens.append(("bare", start, start + len(bare), bare))
            for p in _PARAMETER.finditer(bare):
                self._literal(last_part(p[1]), start + p.start(2), start + p.end(2))
        if tail:
            self.tokens.append(("set" if tail == "=" else "join", start + len(bare), end, tail))
        return end

    def _block(self, at: int) -> int:
        """Lines that are further in than the name of the block; the place after them."""
        text = self.text
        first = text.rfind("\n", 0, self.tokens[-1][1]) + 1
        depth = _indent(text, first)
        name = self._name_before(len(self.tokens) - 1)
        while at < len(text):
            end = self._line_end(at)
            if text[at:end].strip():
                if _indent(text, at) <= depth:
                    break
                if name:
                    self._literal(name, at, end)
            at = min(end + 1, len(text)) if end < len(text) else len(text)
        self.tokens.append(("line", at, at, ""))
        return at

    def _name_before(self, k: int) -> str | None:
        """The name that the operator, token k, assigns to."""
        tokens = self.tokens
        if k < 1:
            return None
        kind, _, _, value = tokens[k - 1]
        if kind == "close" and value == "]" and k > 1 and tokens[k - 2][0] == "string":
            kind, _, _, value = tokens[k - 2]
        if kind == "string":
            return last_part(value) if value.strip() and len(value.split()) == 1 else None
        if kind == "bare":
            return last_part(value) if _IDENT.fullmatch(value) else None
        if kind not in ("name", "variable"):
            return None
        if k > 2 and tokens[k - 3][0] == tokens[k - 2][0] == "name" and tokens[k - 3][3] in ("var", "const") and tokens[k - 2][1] > tokens[k - 3][2]:
            return last_part(tokens[k - 2][3])  # var name type = value
        return last_part(value)


_STOPS = {q: re.compile(rf"[{q}\n]|\\.", re.DOTALL) for q in "\"'"}


def _indent(text: str, at: int) -> int:
    return _SPACES.match(text, at).end() - at


_SPACES = re.compile(r"[ \t]*")


@dataclass
class _Frame:
    """An open bracket: what was assigned to before it, what its own values go to, and the call that it belongs to."""

    bracket: str
    outer: str | None
    base: str | None
    call: str | None = None  # last part of the name that is called
    subscript: bool = False
    first: str | None = None  # its first argument, if that is a string
    commas: int = 0
    outer_open: bool = False


def _matched(tokens: list[tuple[str, int, int, str]]) -> set[int]:
    """Tokens that are brackets with a partner; others count as nothing."""
    pairs, stack, waiting = {")": "(", "]": "[", "}": "{"}, [], {"(": 0, "[": 0, "{": 0}
    matched: set[int] = set()
    for k, (kind, _, _, value) in enumerate(tokens):
        if kind == "open":
            stack.append(k)
            waiting[value] += 1
        elif kind == "close" and waiting[pairs[value]]:
            while stack:
                opened = stack.pop()
                waiting[tokens[opened][3]] -= 1
                if tokens[opened][3] == pairs[value]:
                    matched |= {opened, k}
                    break
    return matched


def _parse(lexer: _Lexer, found: Assignments) -> None:
    tokens, offset, text = lexer.tokens, lexer.offset, lexer.text
    matched = _matched(tokens)
    stack: list[_Frame] = []
    target: str | None = None  # what values go to
    wants = False  # an operand may follow: after an operator, an opening bracket or a comma
    fresh = False  # nothing but line ends since the operator
    asked = 0  # questions whose ":" is still to come
    run: list | None = None  # [name, start, end, value] of the literal that may go on
    glued = False  # the literal goes on with the next string

    def flush() -> None:
        nonlocal run, glued
        if run:
            found.literals[run[0]].append((run[1] + offset, run[2] + offset, run[3]))
        run, glued = None, False

    for k, (kind, start, end, value) in enumerate(tokens):
        frame = stack[-1] if stack else None
        listed = frame is not None and frame.bracket in "(["  # line ends mean nothing there
        if kind == "line":
            if listed or (run and glued):
                glued = run is not None
                continue
            if not (fresh or (k + 1 < len(tokens) and tokens[k + 1][0] == "join" and run) or (wants and k and tokens[k - 1][0] == "join")):
                flush()
                target, wants, asked = frame.base if frame else None, False, 0
            continue
        if kind == "set":
            if value[:1] == ":" and asked:
                asked -= 1
                flush()
                wants = True
                continue
            if run and k and tokens[k - 1][0] == "string":
                run = None  # it was a key
            flush()
            name = lexer._name_before(k)
            if name is None and k and tokens[k - 1][0] == "close" and tokens[k - 1][3] == "]":
                name = _before_bracket(tokens, k - 1)
            target, wants, fresh, asked = name, name is not None, name is not None, 0
            continue
        if kind in ("open", "close") and k not in matched:
            continue
        if kind == "open":
            flush()
            called = tokens[k - 1] if k and tokens[k - 1][2] == start and tokens[k - 1][0] in ("name", "bare") else None
            after = called or (k and tokens[k - 1][0] == "close" and tokens[k - 1][2] == start)
            inside = target if (wants or after) and value != "{" else None
            stack.append(_Frame(value, target, inside, last_part(called[3]).lower() if called and value == "(" else None, bool(after) and value == "[", outer_open=wants and not after))
            target, wants, fresh = inside, inside is not None, False
            continue
        if kind == "close":
            flush()
            closed = stack.pop()
            target, wants, fresh = closed.outer, False, False
            continue
        if kind == "comma":
            flush()
            if frame:
                frame.commas += 1
                if frame.commas == 1 and frame.call in SETTERS and frame.first:
                    frame.base = frame.first
            target = frame.base if frame else None
            wants, fresh, asked = target is not None, False, 0
            continue
        if kind == "end":
            flush()
            target, wants, fresh, asked = frame.base if frame and frame.bracket == "{" else None, False, False, 0
            continue
        if kind == "join":
            glued, wants = run is not None, target is not None
            continue
        if kind == "ask":
            flush()
            asked, wants = asked + 1, target is not None
            continue
        was_fresh, fresh = fresh, False
        if kind == "string":
            word = last_part(value.strip()) if len(value.split()) == 1 else ""
            if frame and frame.bracket == "(" and frame.commas == 0 and frame.first is None:
                frame.first = word or None
            key = k + 1 < len(tokens) and (tokens[k + 1][0] == "set" or (tokens[k + 1][3] == "]" and k + 2 < len(tokens) and tokens[k + 2][0] == "set" and not (frame and not frame.subscript))) and not (asked and tokens[k + 1][3][:1] == ":")
            if was_fresh and key and "\n" in text[tokens[k - 1][2] : start]:
                target = None  # the next line has a key of its own
            if target is None or key:
                continue
            if frame and ((frame.subscript and not run) or (frame.call in GETTERS and frame.commas == 0)):
                if word:
                    found.flows[word].add(target)
                wants = False
            elif frame and frame.call and frame.call not in SETTERS and frame.base == target and not any(c.isdigit() for c in value):
                wants = False  # words that a call is given
            elif run and (glued or tokens[k - 1][0] == "string"):
                run[2], run[3], glued = end, run[3] + value, False
            elif wants:
                flush()
                wants = False
                if "\n" in value:
                    _lines(found, target, value, offset + start)
                else:
                    skip = _SIGN_ON.match(value)
                    start += skip.end() if skip else 0
                    if inner := re.fullmatch(r"\$\{?([^\W\d]\w*)\}?", value):
                        found.flows[inner[1]].add(target)
                    else:
                        run = [target, start, end, text[start:end]]
            continue
        flush() if kind != "name" or value.lower() not in _NO_OPERAND else None
        if target is None:
            continue
        if was_fresh and k and tokens[k - 1][0] == "line" and kind in ("name", "other"):
            target, wants = frame.base if frame else None, False  # the next line is one of its own
        elif kind == "bare":
            called = k + 1 < len(tokens) and tokens[k + 1][3] in ("(", "[") and tokens[k + 1][1] == end and k + 1 in matched
            keyword = value.lower() in _NO_OPERAND
            if not called and not keyword:
                found.literals[target].append((start + offset, end + offset, value))
                if _IDENT.fullmatch(value):
                    found.flows[last_part(value)].add(target)
            wants = keyword
        elif kind in ("name", "variable"):
            if value.lower() in _BETWEEN:
                wants = True
            elif value.lower() in _NO_OPERAND:
                pass
            elif k + 1 < len(tokens) and tokens[k + 1][0] == "set" and tokens[k + 1][3] not in ("=>",) and not asked:
                wants = False
            elif wants:
                found.flows[last_part(value)].add(target)
                wants = False
            elif not (frame and frame.bracket in "([") or kind == "name":
                wants = False
        else:
            wants = False
    flush()


def _before_bracket(tokens: list[tuple[str, int, int, str]], k: int) -> str | None:
    """The name before a bracket of at most a name or number: `values[0] = ...`."""
    return last_part(tokens[k - 3][3]) if k > 2 and tokens[k - 2][3] == "[" and tokens[k - 3][0] == "name" else None


def _lines(found: Assignments, target: str, value: str, at: int) -> None:
    """Each line of a string is a literal."""
    for line in value.split("\n"):
        if own := line.strip():
            start = at + line.index(own)
            found.literals[target].append((start, start + len(own), own))
        at += len(line) + 1
