"""JSON files of any layout as elements, read by many tasks in linear time.

A file is cut after closing braces, wherever they stand, into pieces that Spark's text
reader gives out by byte ranges; pieces are gathered into chunks of about a megabyte.  What
a chunk does to the state of a reader is a small function: whether a string is open after it,
how many open brackets it closes and which ones it opens, for both cases of a string
open or not at its begin.  These functions are composed along each file, a row a
chunk, which gives every chunk its own state; then all chunks are split into elements by
themselves, and the elements that go over the border of a chunk are put together.

Broken files stay readable.  A line break ends a string, as JSON has none within one.  If the
brackets of a file don't add up, a line that begins with ``{`` and is indented no deeper than
the first such line begins an element, whatever was open before.

The functions here work on the bytes of one chunk; ``json_files`` has the jobs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

_QUOTE, _BREAK, _COMMA, _ESCAPE = b'"\n,\\'
_STEP = np.zeros(256, np.int64)
_STEP[list(b"{[")], _STEP[list(b"}]")] = 1, -1
_SPECIAL = np.zeros(256, bool)
_SPECIAL[list(b'"\n,{}[]')] = True
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t")] = True
#: Lines that are indented deeper begin no element of a broken file.
DEEPEST = 64
_NAME = re.compile(rb'"((?:[^"\\]|\\.){0,200})"\s*:\s*\Z')


@dataclass
class Structure:
    """Brackets and commas outside of strings: places, characters, steps of depth, and of
    each ``{`` that begins a line its indent (else -1)."""

    at: np.ndarray
    kind: np.ndarray
    step: np.ndarray
    indent: np.ndarray
    ends_open: bool
    #: Whether a line break stands within a string.
    torn: bool


def structure(data: bytes, open_string: bool) -> Structure:
    a = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(_SPECIAL[a])
    kind = a[at]
    quoted = np.flatnonzero(kind == _QUOTE)
    back = at[quoted] - 1
    slashes = np.zeros(len(back), np.int64)
    going = np.flatnonzero((back >= 0) & (a[back] == _ESCAPE)) if len(back) else back
    while len(going):
        slashes[going] += 1
        back[going] -= 1
        going = going[(back[going] >= 0) & (a[back[going]] == _ESCAPE)]
    if slashes.any():
        kept = np.ones(len(at), bool)
        kept[quoted[slashes % 2 == 1]] = False
        at, kind = at[kept], kind[kept]
    # quotes since the last line break tell whether a string is open
    quotes = np.cumsum(kind == _QUOTE)
    breaks = np.flatnonzero(kind == _BREAK)
    line = np.searchsorted(breaks, np.arange(len(at)), side="right")
    before = np.concatenate([[-int(open_string)], quotes[breaks]])
    within = (quotes - before[line]) % 2 == 1
    torn = bool(((before[1:] - before[:-1]) % 2).any())
    ends_open = bool((int(quotes[-1]) if len(quotes) else 0) - before[-1] & 1)
    own = ~within & (kind != _QUOTE) & (kind != _BREAK)
    at, kind = at[own], kind[own]
    indent = np.full(len(at), -1, np.int64)
    back, deep = at - 1, 0
    going = np.flatnonzero(kind == ord("{"))
    while len(going) and deep <= DEEPEST:
        going = going[back[going] >= 0]
        begins = a[back[going]] == _BREAK
        indent[going[begins]] = deep
        going = going[_BLANK[a[back[going]]]]
        back[going] -= 1
        deep += 1
    return Structure(at, kind, _STEP[kind], indent, ends_open, torn)


def _opened(data: bytes, s: Structure, from_: int = 0) -> tuple[int, list[list]]:
    """How many brackets the structure closes that it doesn't open, and those it leaves
    open, from its event ``from_`` on: (character, name before it or None)."""
    depth = np.cumsum(s.step[from_:])
    if not len(depth):
        return 0, []
    least_after = np.minimum.accumulate(depth[::-1])[::-1]
    left = np.flatnonzero((s.step[from_:] == 1) & (least_after >= depth)) + from_
    named = [(_NAME.search(data, max(0, int(s.at[i]) - 300), int(s.at[i])), i) for i in left]
    return max(0, -int(depth.min())), [[chr(s.kind[i]), m[1].decode(errors="replace") if m else None] for m, i in named]


def summary(data: bytes) -> str:
    """What a chunk does, as JSON: under ``after`` for a closed and for an open string at
    its begin; ``indents`` has for each indent of a line that begins with ``{`` what is open
    after the last line indented no deeper."""
    after = []
    for open_string in (False, True):
        s = structure(data, open_string)
        closes, opens = _opened(data, s)
        depth = np.cumsum(s.step)
        cuts = {*depth[(s.kind == _COMMA) | (s.kind == ord("["))].tolist(), *(depth[s.step == -1] + 1).tolist()}
        after.append({"open": s.ends_open, "closes": closes, "opens": opens, "cuts": sorted(cuts), "closed": sorted({*depth[s.step == -1].tolist()}), "torn": s.torn})
        if not open_string:
            last = s
    # what follows a line break is the same in both cases
    found = np.flatnonzero(last.indent >= 0)
    indents = {}
    for deep in np.unique(last.indent[found]).tolist():
        i = int(found[last.indent[found] <= deep][-1])
        indents[deep] = _opened(data, last, i)[1]
    begin = data.removeprefix(b"\xef\xbb\xbf").lstrip()[:1].decode(errors="replace")
    return json.dumps({"after": after, "indents": indents, "indent": int(last.indent[found[0]]) if len(found) else None, "begin": begin})


@dataclass
class State:
    """Where a chunk stands: whether a string is open, what brackets are, at what depth the
    elements are, the indent at which lines begin elements (None in a whole file), and
    the number of the chunk where the element that goes on began (-1 in the first chunk)."""

    open_string: bool
    stack: list[list]
    base: int
    indent: int | None
    since: int

    def to_json(self) -> str:
        return json.dumps([self.open_string, self.stack, self.base, self.indent, self.since])

    @staticmethod
    def from_json(text: str) -> State:
        return State(*json.loads(text))


def compose(summaries: Sequence[str], wrapped: bool) -> tuple[list[State], bool]:
    """The states of the chunks of a file, in order, and whether its brackets add up.

    ``wrapped``: the elements are in lists under the keys of one object.
    """
    parts = [json.loads(s) for s in summaries]
    begin = next((p["begin"] for p in parts if p["begin"]), "")
    base = 1 if begin == "[" else 2 if wrapped and begin == "{" else 0
    level = next((p["indent"] for p in parts if p["indent"] is not None), None)

    def follow(level: int | None) -> tuple[list[State], bool]:
        states, whole = [], True
        open_string, stack, since = False, [], -1
        for number, part in enumerate(parts):
            states.append(State(open_string, stack, base, level, since))
            after, depth = part["after"][open_string], len(stack)
            cut = base - depth in after["cuts"] or (base == 0 and -depth in after["closed"])
            whole &= after["closes"] <= depth and not after["torn"]
            fitting = [int(d) for d in part["indents"] if level is not None and int(d) <= level]
            if fitting:
                stack, cut = [*stack[:base], *[["[", None]] * (base - len(stack)), *part["indents"][str(max(fitting))]], True
            else:
                stack = [*stack[: max(0, depth - after["closes"])], *after["opens"]]
            open_string, since = after["open"], number if cut or number == 0 else since
        return states, whole and not open_string and not stack

    states, whole = follow(None)
    return (states, whole) if whole or level is None or base == 2 else (follow(level)[0], False)


def split(data: bytes, state: State) -> Iterator[tuple[bytes, bool, bool, str | None]]:
    """(text, goes on from the chunk before, goes on in the next one, name of its list) of
    the parts of a chunk, blank ones and what is outside of all lists included."""
    s, base = structure(data, state.open_string), state.base
    depth = len(state.stack) + np.cumsum(s.step)
    restarts = np.zeros(len(s.at), bool)
    if state.indent is not None:
        restarts = (s.indent >= 0) & (s.indent <= state.indent)
        last = np.maximum.accumulate(np.where(restarts, np.arange(len(s.at)), -1))
        steps = np.cumsum(s.step)
        depth = np.where(last >= 0, base + 1 + steps - steps[last], depth)
    divides = ((s.kind == _COMMA) & (depth == base)) | ((s.kind == ord("[")) & (depth == base))
    closes = (s.step == -1) & (depth == base - 1)
    ends = (s.step == -1) & (depth == 0) & (base == 0)
    cuts = np.flatnonzero(divides | closes | ends | restarts)
    stops = s.at[cuts] + ends[cuts]
    starts = s.at[cuts] + ~restarts[cuts]
    name = state.stack[1][1] if base == 2 and len(state.stack) > 1 and state.stack[1][0] == "[" else None
    lists = np.flatnonzero((s.step == 1) & (depth == 2)) if base == 2 else []
    names = {int(i): (m[1].decode(errors="replace") if s.kind[i] == ord("[") and (m := _NAME.search(data, max(0, int(s.at[i]) - 300), int(s.at[i]))) else None) for i in lists}
    begin = 0
    for k, (cut, stop, start) in enumerate(zip(cuts.tolist(), stops.tolist(), starts.tolist(), strict=True)):
        yield data[begin:stop], k == 0 and state.since >= 0, False, name
        begin = start
        if base == 2:
            name = None if closes[cut] else names.get(cut, name)
    yield data[begin:], not len(cuts) and state.since >= 0, True, name
