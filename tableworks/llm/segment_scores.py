"""Scores of candidate segments without letters, all segments of a window at once.

The field of ``personal_data`` sums weights of features of whole segments. For segments of digits and
separators every feature follows from numbers that grow with the segment: its digits, groups, kinds
of separators, check sums. They are kept for all beginnings of a window side by side and extended
token by token, so numpy scores some hundred thousand segments in one go and no feature is spelt out
but for the few different values that a window holds.
"""

import numpy as np

#: Positions of groups that the phone feature spells, and the length it counts to.
_GROUPS, _LONG = 5, 5


class Tokens:
    """What the recursion needs of every token of a window, as arrays."""

    def __init__(self, text: str, starts: list[int], ends: list[int]):
        self.size = count = len(starts)
        self._gaps = {"": 0}
        base = starts[0] if count else 0
        # One more character on either side tells whether a word goes on.
        around = (text[base - 1] if base else " ") + text[base : ends[-1] + 1 if count else base] + " "
        codes = np.frombuffer(around.encode("utf-32-le", "surrogatepass"), np.uint32)
        start, end = np.array(starts, np.int64) - base + 1, np.array(ends, np.int64) - base + 1
        kinds, which = np.unique(codes, return_inverse=True)
        found = [chr(code) for code in kinds.tolist()]

        def told(test) -> np.ndarray:
            return np.array([test(c) for c in found], bool)[which]

        digit, word = told(str.isdigit), told(str.isalnum)
        plain = told(lambda c: c.isascii() and c.isalnum())[start]
        size = end - start
        number = plain & digit[start]
        self.digits = np.where(digit[start], size, 0)
        self.ascii_digits = np.where(number, size, 0)
        self.letter = told(str.isalpha)[start] & ~digit[start]
        first = codes[start]
        self.line_end, self.at = first == 10, first == 64
        self.head = (plain | (first == 43) | (first == 40)) & ~word[start - 1]
        self.stop = plain & ~word[end]
        self.separator = np.full(count, -1)
        separators, self.separator[~plain] = np.unique(first[~plain], return_inverse=True)
        self.separators = [chr(code) for code in separators.tolist()]
        self.mark = self.at.copy()
        for k in np.flatnonzero(self.letter & (size >= 2) & (size <= 3)).tolist():
            self.mark[k] = text[starts[k] : ends[k]].lower() in ("at", "dot")
        self._numbers(codes, start, end, number)
        self.gap = np.zeros(count, np.int64)
        places = np.flatnonzero(number).tolist()
        for before, k in zip(places, places[1:]):
            self.gap[k] = self.gap_number(text[ends[before] : starts[k]])
        # The last letters up to each token.
        self.last_letter = np.maximum.accumulate(np.where(self.letter, np.arange(count), -1)) if count else start

    def _numbers(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, number: np.ndarray) -> None:
        """Check sums of numbers, with the last digit as it is and with it doubled, and octets.

        No number of more than 19 digits is a card, nor one of more than 3 an octet.
        """
        self.octet = np.zeros(len(start), bool)
        self.sums = np.zeros((2, len(start)), np.int64)
        own = np.flatnonzero(number & (end - start <= 19))
        if not len(own):
            return
        size = end[own] - start[own]
        first = np.cumsum(size) - size
        back = np.repeat(first + size - 1, size) - np.arange(size.sum())
        digit = codes[np.repeat(end[own] - 1, size) - back].astype(np.int64) - 48
        twice = np.where(digit > 4, 2 * digit - 9, 2 * digit)
        odd = back % 2 == 1
        self.sums[0, own] = np.add.reduceat(np.where(odd, twice, digit), first) % 10
        self.sums[1, own] = np.add.reduceat(np.where(odd, digit, twice), first) % 10
        value = np.add.reduceat(np.where(back < 3, digit * 10 ** np.minimum(back, 3), 0), first)
        self.octet[own] = (size <= 3) & (value <= 255)

    def word_before(self, i: int) -> int | None:
        """The last of the five tokens before a token that is letters; None if the window begins there."""
        if i < 5:
            return None
        return max(int(self.last_letter[i - 1]), i - 6)

    def gap_number(self, gap: str) -> int:
        return self._gaps.setdefault(gap.strip(), len(self._gaps))


class SegmentScorer:
    def __init__(self, weights: dict[tuple[str, str], float], kinds: tuple[str, ...], plain_separators):
        self.weights, self.kinds, self.is_plain = weights, kinds, plain_separators

    def _of(self, *names: str) -> np.ndarray:
        get = self.weights.get
        return np.array([sum(get((kind, name), 0.0) for name in names) for kind in self.kinds])

    def _by_value(self, values: np.ndarray, names) -> np.ndarray:
        """Weights of the features that ``names`` gives for each value."""
        different, where = np.unique(values, return_inverse=True)
        return np.array([self._of(*names(value)) for value in different.tolist()])[where]

    def _separator_names(self, tokens: Tokens):
        def names(mask: int) -> list[str]:
            found = "".join(sorted(c for k, c in enumerate(tokens.separators) if mask >> k & 1))
            return ["sep=" + found[:6]] + ["plain separators"] * self.is_plain(found)

        return names

    def positive(self, text, starts, ends, tokens: Tokens, before, most: int, low: int):
        """(first, end, kind, score) of segments without letters that score above zero.

        ``before`` tells the word before a token where it may stand ahead of the window. Segments begin at token ``low`` at
        the earliest.
        """
        heads = np.flatnonzero(tokens.head & ~tokens.letter)
        heads = heads[heads >= low]
        none = np.zeros(0, np.int64)
        if not len(heads):
            return none, none, none, np.zeros(0)
        if len(tokens.separators) > 62:
            raise OverflowError("too many kinds of separators")
        size = len(heads)
        digits, ascii_digits, groups = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        mask, run, code = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        plain_sum, doubled_sum = np.zeros(size, np.int64), np.zeros(size, np.int64)
        marks, long_gap = np.zeros(size, bool), np.zeros(size, bool)
        octets, even, fours, all_fours = (np.ones(size, bool) for _ in range(4))
        gap = np.full(size, -1)
        lead = {}
        for k, i in enumerate(heads.tolist()):
            if not tokens.ascii_digits[i]:
                j = i + 1
                while j < tokens.size and j < i + most and not tokens.ascii_digits[j]:
                    j += 1
                if j < tokens.size:
                    lead[k] = tokens.gap_number(text[starts[i] : starts[j]])
        leading = np.full(size, -1)
        if lead:
            leading[list(lead)] = list(lead.values())
        alive = np.arange(size)
        found = []
        for step in range(most):
            at = heads[alive] + step
            fine = at < tokens.size
            alive, at = alive[fine], at[fine]
            fine = ~tokens.line_end[at] & ~tokens.letter[at]
            alive, at = alive[fine], at[fine]
            if not len(alive):
                break
            amount = tokens.ascii_digits[at]
            digits[alive] += tokens.digits[at]
            marks[alive] |= tokens.at[at]
            separate = tokens.separator[at]
            apart = separate >= 0
            mask[alive[apart]] |= np.int64(1) << separate[apart].astype(np.int64)
            run[alive] = np.where(apart, run[alive] + 1, 0)
            long_gap[alive] |= run[alive] >= 3
            number = alive[amount > 0]
            if len(number):
                here = at[amount > 0]
                size_here = amount[amount > 0]
                swap = size_here % 2 == 1
                p, d = plain_sum[number], doubled_sum[number]
                plain_sum[number] = (np.where(swap, d, p) + tokens.sums[0, here]) % 10
                doubled_sum[number] = (np.where(swap, p, d) + tokens.sums[1, here]) % 10
                first = groups[number] == 0
                between = np.where(first, leading[number], tokens.gap[here])
                known = between >= 0
                seen = gap[number]
                even[number] &= ~known | (seen < 0) | (seen == between)
                even[number] &= ~known | (between != 0)
                gap[number] = np.where(known & (seen < 0), between, seen)
                octets[number] &= tokens.octet[here]
                fours[number] = all_fours[number]
                all_fours[number] &= size_here == 4
                room = groups[number] < _GROUPS
                code[number] = np.where(room, code[number] * (_LONG + 1) + np.minimum(size_here, _LONG), code[number])
                ascii_digits[number] += size_here
                groups[number] += 1
            done = tokens.stop[at] & ((digits[alive] >= 4) | marks[alive])
            ending = alive[done]
            if len(ending):
                scores = self._scores(
                    tokens, ending, ascii_digits, groups, mask, long_gap, octets, even & (gap > 0),
                    plain_sum % 10 == 0, fours, code,
                )
                found.append((ending, heads[ending] + step + 1, scores))
        if not found:
            return none, none, none, np.zeros(0)
        which, stops = (np.concatenate([part[k] for part in found]) for k in (0, 1))
        scores = np.concatenate([part[2] for part in found])
        used = np.unique(which)
        context = np.zeros((size, len(self.kinds)))
        words: dict[str, np.ndarray] = {}
        for k in used.tolist():
            i = int(heads[k])
            at, sign = tokens.word_before(i), text[starts[i]]
            word = before(i) if at is None else text[starts[at] : ends[at]].lower() if at > i - 6 else ""
            key = word + "\n" + (sign if sign in "+(" else "d")
            if key not in words:
                words[key] = self._of("before=" + word, "head=" + key[-1])
            context[k] = words[key]
        scores = scores + context[which]
        kind = scores.argmax(axis=1)
        best = scores[np.arange(len(scores)), kind]
        above = best > 0
        return heads[which[above]], stops[above], kind[above], best[above]

    def _scores(self, tokens, own, digits, groups, mask, long_gap, octets, even, checks, fours, code):
        total = np.tile(self._of("bias", "no letters"), (len(own), 1))
        total += self._by_value(np.minimum(digits[own], 20), lambda n: ["n=%d" % n])
        total += self._by_value(np.minimum(groups[own], 8), lambda n: ["groups=%d" % n])
        total += self._by_value(mask[own], self._separator_names(tokens))
        total += long_gap[own, None] * self._of("long gap")
        four = (groups[own] == 4) & octets[own]
        total += np.where(four & even[own], 1.0, 0.0)[:, None] * self._of("octets even")
        total += np.where(four & ~even[own], 1.0, 0.0)[:, None] * self._of("octets mixed")
        card = (digits[own] >= 13) & (digits[own] <= 19)
        for flag, yes, no in ((checks, "check digit fits", "check digit fails"), (fours, "fours", "no fours")):
            total += np.where(card & flag[own], 1.0, 0.0)[:, None] * self._of(yes)
            total += np.where(card & ~flag[own], 1.0, 0.0)[:, None] * self._of(no)
        phone = (digits[own] >= 10) & (digits[own] <= 12)

        def spelt(value: int) -> list[str]:
            sizes = []
            while value:
                value, size = divmod(value, _LONG + 1)
                sizes.append(str(size))
            return ["phone groups " + "-".join(reversed(sizes))] if sizes else []

        total += self._by_value(np.where(phone, code[own], 0), spelt)
        return total
