"""Byte pair encoding by dynamic programming over prefixes.

Every prefix of a text has exactly one last token in the encoding of that prefix: of the tokens that end there it is the one
that is compatible with its predecessor, the last token of the prefix before it. Two tokens are compatible if, put side by
side, they encode to themselves.

LastTokens finds the tokens that end at each position by a suffix automaton over the vocabulary (Aho-Corasick), stores the last
token of every prefix and follows these back from the end to the ids. CountingTransducer only counts: what decides the next
step is the set of open trie paths with the last token stored where each began, so that set is a state, and each transition is
annotated with the change of the token count. Its states are made when they are first met and forgotten at a limit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import ahocorasick

#: No token: the start of a stretch that nothing merges into.
EDGE = -1
#: Results of pair tests that are kept.
PAIRS = 200_000


class Merges:
    """tokens: id and symbols; rank(a, b): order of the merge of two strings, None if there is none."""

    def __init__(self, tokens: dict[int, str], rank: Callable[[str, str], float | None]):
        self.rank, self.text = rank, tokens
        self.size = max(tokens, default=0) + 2
        self.fits: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Merge by rank, leftmost first: the definition, used on a token or a pair of tokens."""
        parts = list(text)
        ranks = [self.rank(a, b) for a, b in zip(parts, parts[1:], strict=False)]
        while any(r is not None for r in ranks):
            at = min((r, i) for i, r in enumerate(ranks) if r is not None)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            for i in (at - 1, at):
                if 0 <= i < len(ranks):
                    ranks[i] = self.rank(parts[i], parts[i + 1])
        return parts

    def compatible(self, before: int, token: int) -> bool:
        key = (before + 1) * self.size + token
        fit = self.fits.get(key)
        if fit is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            own = [self.text[token]] if before == EDGE else [self.text[before], self.text[token]]
            fit = self.fits[key] = self.merged("".join(own)) == own
        return fit


class LastTokens:
    """Ids of words; every symbol of a word must be a token."""

    def __init__(self, tokens: dict[int, str], rank: Callable[[str, str], float | None]):
        self.merges = Merges(tokens, rank)
        self.length = {i: len(t) for i, t in tokens.items()}
        self.suffixes = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, t in tokens.items():
            self.suffixes.add_word(t, i)
        self.suffixes.make_automaton()

    def encode(self, word: str) -> list[int]:
        length, merges = self.length, self.merges
        fits, size = merges.fits, merges.size
        last = [EDGE] * (len(word) + 1)
        for end, token in self.suffixes.iter(word):
            if last[end + 1] == EDGE:
                before = last[end + 1 - length[token]]
                fit = fits.get((before + 1) * size + token)
                if fit or fit is None and merges.compatible(before, token):
                    last[end + 1] = token
        ids, at = [], len(word)
        while at:
            ids.append(last[at])
            at -= length[last[at]]
        ids.reverse()
        return ids


class State(dict):
    """Symbol: (next state, change of the token count). paths: (trie node, last token before it, tokens behind it); symbol: the one
    read last."""

    __slots__ = ("home", "paths", "symbol")

    def __init__(self, home: CountingTransducer, paths: tuple):
        super().__init__()
        self.home, self.paths = home, paths
        last = paths[-1][1]
        self.symbol = "" if last == EDGE else home.merges.text[last][-1]

    def __missing__(self, symbol: str) -> tuple[State, int]:
        return self.home.step(self, symbol)


#: The paths of the start state.
START = ((0, EDGE, 0),)


class CountingTransducer:
    """weights: what each token counts for (a character without a piece of its own counts its bytes).

    Nothing merges across two symbols that no token holds side by side, so there a step is that of the start state.
    """

    def __init__(self, tokens: dict[int, str], weights: dict[int, int], rank: Callable[[str, str], float | None], limit: int = 400_000):
        self.merges, self.weights, self.limit = Merges(tokens, rank), weights, limit
        self.adjacent = {t[i : i + 2] for t in tokens.values() for i in range(len(t) - 1)}
        self.edges: dict[int, int] = {}  # node * 2 ** 21 + symbol: node
        self.token, self.inner = [EDGE], [False]
        for i, text in tokens.items():
            node = 0
            for c in text:
                self.inner[node] = True
                after = self.edges.get(node << 21 | ord(c))
                if after is None:
                    after = self.edges[node << 21 | ord(c)] = len(self.token)
                    self.token.append(EDGE)
                    self.inner.append(False)
                node = after
            self.token[node] = i
        self.states: dict[tuple, State] = {}
        self.size = 0

    def state(self, paths: tuple) -> State:
        s = self.states.get(paths)
        if s is None:
            s = self.states[paths] = State(self, paths)
        return s

    def forget(self) -> None:
        """Drop all transitions. States that are in use stay right: they make theirs again."""
        for s in self.states.values():
            s.clear()
        self.states.clear()
        self.size = 0

    def step(self, state: State, symbol: str) -> tuple[State, int]:
        if self.size >= self.limit:
            self.forget()
        self.size += 1
        if state.symbol and state.symbol + symbol not in self.adjacent:
            made = state[symbol] = self.state(START)[symbol]
            return made
        code, compatible = ord(symbol), self.merges.compatible
        found, before, open_ = EDGE, 0, []
        for node, last, behind in state.paths:  # the longest first
            after = self.edges.get(node << 21 | code)
            if after is None:
                continue
            t = self.token[after]
            if found == EDGE and t != EDGE and compatible(last, t):
                found, before = t, behind
            if self.inner[after]:
                open_.append((after, last, behind))
        if found == EDGE:  # a symbol that no token holds
            made = (self.state(START), len(symbol.encode("utf-8", "surrogatepass")))
        else:
            change = before + self.weights[found]
            made = (self.state((*[(n, t, b - change) for n, t, b in open_], (0, found, 0))), change)
        state[symbol] = made
        return made

    def run(self, text: str, state: State) -> tuple[State, int]:
        """Exit state and change of the token count over a text, entered in that state."""
        n = 0
        for c in text:
            state, change = state[c]
            n += change
        return state, n
