"""Cutting texts where a byte-level BPE pattern always cuts, and caching what the parts give."""

import re

#: A space before a character that no library takes for white space always starts a new
#: pre-token, whatever stands around it.
_CUT = re.compile(r"(?= [^\s\x1c-\x1f])")
_ODD = re.compile(r" (?:[\s\x1c-\x1f]|$)")


def parts_of(text):
    """Parts of a text whose tokens do not depend on each other, in order.

    Every part but the first starts with a single space.
    """
    if _ODD.search(text):
        return [part for part in _CUT.split(text) if part]
    first, *rest = text.split(" ")
    parts = [" " + part for part in rest]
    return [first, *parts] if first else parts


ENDS = (",", ".")


class PartCache:
    """What ``encode`` gives for parts; emptied when it holds ``limit`` parts or ``chars`` characters.

    A plain dict of strings and bytes is left alone by Python's garbage collector, which would
    walk a subclass of dict, however many parts it holds, with every full collection.
    """

    def __init__(self, encode, limit=1_000_000, chars=16_000_000):
        self.encode, self.limit, self.chars, self.held, self.known = encode, limit, chars, 0, {}

    def __len__(self):
        return len(self.known)

    def of_all(self, lists):
        """What the parts of each list give, joined; unknown parts are encoded in one call."""
        if len(self) >= self.limit or self.held >= self.chars:
            self.known.clear()
            self.held = 0
        known = self.known
        found = [list(map(known.get, parts)) for parts in lists]
        gaps = [[i for i, value in enumerate(values) if value is None] if None in values else () for values in found]
        if any(gaps):
            self._learn({parts[i] for parts, own in zip(lists, gaps) for i in own})
            for parts, values, own in zip(lists, found, gaps):
                for i in own:
                    values[i] = known[parts[i]]
        return [b"".join(values) for values in found]

    def _learn(self, new):
        """A comma or full stop after a letter is a pre-token of its own, so such a part is
        put together from the part without it, which is often known already."""
        known = self.known
        self.held += sum(map(len, new))
        ended = {p for p in new if p[-1:] in ENDS and p[-2:-1].isalpha()}
        stems = {p[:-1] for p in ended if p[:-1] not in known}
        whole = [*(new - ended | stems | set(ENDS))]
        known.update(zip(whole, self.encode(whole)))
        known.update([(p, known[p[:-1]] + known[p[-1]]) for p in ended])
