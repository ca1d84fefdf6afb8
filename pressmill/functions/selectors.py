"""Selectors: the part of CSS that extraction rules are written in.

``div.entry-content[class*="x"] p`` - type, classes, id, attribute tests (=, *=, ^=, $=, ~=, mere presence, and %= for a
word between blanks, hyphens and underscores; a trailing `` i`` ignores case), descendants, children (``>``) and lists. ``css@name`` asks for an attribute, else the text.
"""

import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

_STEP = re.compile(r'\s*(>)?\s*([\w*-]+)?((?:[.#][\w-]+|\[[^\]]*\])*)')
_TEST = re.compile(r'\.([\w-]+)|#([\w-]+)|\[\s*([\w:-]+)\s*(?:([*^$~%]?=)\s*"?([^"\]]*?)"?(\s+i)?)?\s*\]')
_TESTS = {"=": lambda have, want: have == want, "*=": lambda have, want: want in have, "^=": str.startswith, "$=": str.endswith,
          "~=": lambda have, want: want in have.split(), "%=": lambda have, want: want in re.split(r"[-_\s]+", have)}


class Step:
    """One element of a selector: its type ('' for any) and the tests on its attributes."""

    def __init__(self, child, tag, tests):
        self.child, self.tag, self.tests = child, "" if tag in (None, "*") else tag.lower(), tests

    def fits(self, tag, given):
        if self.tag and self.tag != tag:
            return False
        for name, how, want, fold in self.tests:
            have = given.get(name)
            if have is None:
                return False
            if how and not _TESTS[how](have.lower() if fold else have, want):
                return False
        return True


def parse(css):
    """The steps of a selector, outermost first."""
    steps, at, css = [], 0, css.strip()
    while at < len(css):
        found = _STEP.match(css, at)
        if found.end() == at:
            raise ValueError(f"no selector: {css!r}")
        tests = []
        for cls, ident, name, how, want, fold in _TEST.findall(found.group(3)):
            if cls:
                tests.append(("class", "~=", cls, False))
            elif ident:
                tests.append(("id", "=", ident, False))
            else:
                tests.append((name.lower(), how, want.lower() if fold else want, bool(fold)))
        steps.append(Step(bool(found.group(1)), found.group(2), tests))
        at = found.end()
    return steps


class Sheet:
    """The rules of an outlet: (kind, place in its kind, css, attribute, how), compiled once per process."""

    def __init__(self, rules):
        self.rules, self.by_tag = [], {}
        for number, (kind, n, css, attribute, how) in enumerate(rules):
            self.rules.append((kind, n, attribute, how))
            for one in re.split(r",(?![^\[]*\])", css):
                steps = parse(one)
                self.by_tag.setdefault(steps[-1].tag, []).append((number, steps))

    def matches(self, tag, given, above):
        """Numbers of the rules that an element fits; ``above`` lists (tag, attributes) of its ancestors, outermost first."""
        found = set()
        for number, steps in (*self.by_tag.get(tag, ()), *self.by_tag.get("", ())):
            if number not in found and steps[-1].fits(tag, given) and (len(steps) == 1 or _below(steps, above)):
                found.add(number)
        return sorted(found)


def _below(steps, above):
    """Whether the outer steps hold along the ancestors (each taken as near as it can be)."""
    def search(k, upto):
        if k < 0:
            return True
        near = steps[k + 1].child
        for i in range(upto - 1, -1, -1):
            if steps[k].fits(*above[i]) and search(k - 1, i):
                return True
            if near:
                return False
        return False

    return search(len(steps) - 2, len(above))


@lru_cache(maxsize=1024)
def sheet(rules):
    return Sheet(rules)


def covered(size, ranges):
    """Per position whether one of the ``ranges`` (first, last) holds it."""
    edge = [0] * (size + 1)
    for first, last in ranges:
        edge[first] += 1
        edge[last + 1] -= 1
    out, depth = [], 0
    for i in range(size):
        depth += edge[i]
        out.append(depth > 0)
    return out


def between(nodes, first, last):
    """Places [a, b) of the sorted ``nodes`` that lie in first..last."""
    return bisect_left(nodes, first), bisect_right(nodes, last)
