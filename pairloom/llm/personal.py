"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

Four kinds follow from patterns alone (email, ip, card, phone). What has no pattern of its own is
found by the chain: persons, addresses, birth dates, identity numbers, and contacts in forms
that the patterns miss (``anna at example dot org``, ``(030) 1234567``). A token is a run of letters, a run
of digits, or one other character. Its features are the shapes around it (case and
length of words, length of numbers, the character itself), pairs and triples of shapes,
the blanks between, whether a word is said again, and the words that the training table holds often enough. A label is
outside, or begins or goes on in one of the kinds.

Training reads a small labelled table, at most ``TRAIN_ROWS`` rows by a hash of their texts, in
the driver: likelihood by forward-backward passes, AdaGrad steps over small batches.
Decoding is Viterbi in numpy over all sentences of a batch of texts at once. Sentences end
at a line break, or behind ``.!?`` after a word of five or more letters if a blank follows. A
sentence in which no token's gain over "outside" makes up for the best transitions is all outside
without decoding: the bound is exact.

Texts are whole, however long. Spans are in code points, end exclusive. A span of the chain
that overlaps a pattern's is dropped; those of the patterns always stay. Null and empty texts
have no spans, every row of a table gives one row, repeated ones too, and columns are kept
under their names. Patterns take time linear in the text. Without training rows nothing but the
patterns is found.
"""

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, slices, with_fields

#: The most labelled rows to train on.
TRAIN_ROWS = 4000
EPOCHS = 15
SENTENCES_PER_STEP = 32
RATE = 0.2
PENALTY = 2e-4
#: A word of the training table is a feature from so many occurrences on.
LEAST_WORD = 3
#: Code points that a batch of texts has at most, if its texts are shorter than that.
CHARS_AT_ONCE = 1 << 20

# The base kinds, in the order in which equal starts are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
FOUND_KINDS = ("person", "address", "birth", "idnum", "contact")
SPAN = "struct<kind: string, start: bigint, end: bigint>"

# ---- patterns ----
# `++` gives nothing back; the classes beside it are disjoint, so it matches what `+` would.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGITS = re.compile(r"[^0-9]+")


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def _luhn(digits: str) -> bool:
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def _part_fits(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the patterns' matches, in order."""
    out = [(s, 0, e) for s, e in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_part_fits, m.groups()))]
    for m in _CARD.finditer(text):
        digits = _NO_DIGITS.sub("", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NO_DIGITS.sub("", m[0])) <= 15]
    return sorted(out)


# ---- tokens and shapes ----
_SPACE, _LETTER, _DIGIT, _MARK = range(4)
_CODES = 0x100


def _table(kind) -> np.ndarray:
    return np.array([kind(chr(c)) for c in range(_CODES + 1)])


def _class(c: str) -> int:
    if c.isspace():
        return _SPACE
    if c in "0123456789":
        return _DIGIT
    return _LETTER if c.isalpha() or c == chr(_CODES) else _MARK


#: Characters beyond Latin-1 count as lower-case letters.
_CLASS = _table(_class).astype(np.int8)
_UPPER = _table(lambda c: c.isupper() and c != chr(_CODES)).astype(np.int64)
_LOWERED = _table(lambda c: ord(c.lower()) if len(c.lower()) == 1 and ord(c) < _CODES else ord(c)).astype(np.uint32)
_LETTER_BUCKET = np.array([0, 0, 1, 2, 3, 3, 4, 4, 4, 5])
_DIGIT_BUCKET = np.array([0, *range(13), 13, 13, 14, 15])
#: Shapes: five cases by six lengths, sixteen lengths of numbers, the characters below 128, all others, none.
SHAPES = 30 + 16 + 128 + 2
_NONE = SHAPES - 1
_HASH_CHARS = 24
_POWERS = np.array([pow(0x100000001B3, k, 1 << 64) for k in range(_HASH_CHARS)], np.uint64)


@dataclass
class Tokens:
    """Tokens of a batch of texts: where they are, what they look like, and which sentence they are in."""

    starts: np.ndarray
    ends: np.ndarray
    shapes: np.ndarray
    words: np.ndarray  # hashes of lower-cased words, 0 for other tokens
    blank_before: np.ndarray
    sentence: np.ndarray


def tokens_of(text: str) -> Tokens:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    small = np.minimum(codes, _CODES)
    kind = _CLASS[small]
    opens = np.ones(len(codes), bool)
    opens[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _MARK)
    at = np.flatnonzero(opens)
    ends = np.append(at[1:], len(codes))
    solid = kind[at] != _SPACE
    line = np.cumsum(codes == 10)
    starts, ends = at[solid], ends[solid]
    kinds, size = kind[starts], ends - starts
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Tokens(none, none, none, none.astype(np.uint64), none.astype(bool), none)
    # A token's characters end where the next token or blank run starts.
    upper = np.concatenate([[0], np.cumsum(_UPPER[small])])
    caps, first = upper[ends] - upper[starts], _UPPER[small[starts]]
    case = np.select([caps == 0, (caps == size) & (size > 1), (caps == 1) & (first == 1) & (size > 1), size == 1], [0, 2, 1, 3], 4)
    shapes = np.select(
        [kinds == _LETTER, kinds == _DIGIT],
        [case * 6 + _LETTER_BUCKET[np.minimum(size, 9)], 30 + _DIGIT_BUCKET[np.minimum(size, len(_DIGIT_BUCKET) - 1)]],
        46 + np.minimum(codes[starts], 128),
    )
    place = np.arange(len(codes)) - np.repeat(at, np.diff(np.append(at, len(codes))))
    lowered = np.where(codes < _CODES, _LOWERED[small], codes).astype(np.uint64) + np.uint64(1)
    part = np.where(place < _HASH_CHARS, lowered * _POWERS[np.minimum(place, _HASH_CHARS - 1)], np.uint64(0))
    words = np.where(kinds == _LETTER, np.add.reduceat(part, at)[solid] | np.uint64(1), np.uint64(0))
    blank = np.ones(len(starts), bool)
    blank[1:] = starts[1:] > ends[:-1]
    stop = np.isin(codes[starts], [33, 46, 63]) & (kinds == _MARK)
    after_word = np.zeros(len(starts), bool)
    after_word[1:] = (kinds[:-1] == _LETTER) & (size[:-1] >= 5) & ~blank[1:]
    new = np.zeros(len(starts), bool)
    new[1:] = (line[starts[1:]] != line[starts[:-1]]) | (stop & after_word)[:-1] & blank[1:]
    return Tokens(starts, ends, shapes.astype(np.int64), words, blank, np.cumsum(new))


def _word_hash(word: str) -> int:
    return int(tokens_of(word).words[0])


# ---- features ----
_TRIPLES = 1 << 14
_SHAPE_AT, _WORD_AT = range(-2, 3), range(-3, 3)


def _features(tokens: Tokens, lexicon: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Feature numbers of every token, one array for each template, and how many numbers there are."""
    # Three empty places between sentences, so that a neighbour never is one of another.
    place = np.arange(len(tokens.starts)) + 3 * tokens.sentence + 3
    room = (int(place[-1]) if len(place) else 0) + 4
    shape = np.full(room, _NONE)
    shape[place] = tokens.shapes
    word = np.zeros(room, np.int64)
    if len(lexicon):
        found = np.minimum(np.searchsorted(lexicon, tokens.words), len(lexicon) - 1)
        word[place] = np.where(lexicon[found] == tokens.words, found + 1, 0)
    blank = np.ones(room, np.int64)
    blank[place] = tokens.blank_before
    out, base = [], 0

    def add(numbers: np.ndarray, many: int) -> None:
        nonlocal base
        out.append(numbers + base)
        base += many

    same = np.zeros(room + 1, np.int64)  # the word before it again
    same[place[1:]] = (tokens.words[1:] == tokens.words[:-1]) & (tokens.words[1:] > 0) & (np.diff(place) == 1)
    add(2 * same[place] + same[place + 1], 4)
    for k in _SHAPE_AT:
        add(shape[place + k], SHAPES)
    for k in _WORD_AT:
        add(word[place + k], len(lexicon) + 1)
    here, before, behind = shape[place], shape[place - 1], shape[place + 1]
    add((before * SHAPES + here) * 2 + blank[place], 2 * SHAPES**2)
    add((here * SHAPES + behind) * 2 + blank[place + 1], 2 * SHAPES**2)
    add(((before * SHAPES + here) * SHAPES + behind) * 2654435761 % (1 << 32) >> 18, _TRIPLES)
    add((word[place - 1] * SHAPES + here), (len(lexicon) + 1) * SHAPES)
    add((word[place - 2] * SHAPES + here), (len(lexicon) + 1) * SHAPES)
    return out, base


# ---- the chain ----
_OUTSIDE = 0
_NEVER = -1e4


def _legal(kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """Which labels may follow each other and begin; label 1 + 2k begins kind k, 2 + 2k goes on in it."""
    labels = 1 + 2 * kinds
    follow = np.ones((labels, labels), bool)
    begin = np.ones(labels, bool)
    for k in range(kinds):
        on = 2 + 2 * k
        begin[on] = False
        follow[:, on] = False
        follow[[on - 1, on], on] = True
    return follow, begin


@dataclass
class Chain:
    kinds: tuple[str, ...]
    lexicon: np.ndarray  # sorted hashes of the words that are features
    weights: np.ndarray  # feature by label
    follow: np.ndarray
    begin: np.ndarray

    def emissions(self, tokens: Tokens) -> np.ndarray:
        out = np.zeros((len(tokens.starts), self.weights.shape[1]), np.float32)
        for numbers in _features(tokens, self.lexicon)[0]:
            out += self.weights.take(numbers, 0)
        return out

    def labels(self, tokens: Tokens) -> np.ndarray:
        """The best label sequence of every sentence."""
        out = np.zeros(len(tokens.starts), np.int64)
        if not len(out):
            return out
        scores = self.emissions(tokens)
        starts = np.flatnonzero(np.diff(tokens.sentence, prepend=-1))
        lengths = np.diff(np.append(starts, len(out)))
        # Leaving "outside" touches two transitions for each token at most.
        move = max(0.0, float(max((self.follow - self.follow[0, 0]).max(), (self.begin - self.begin[0]).max())))
        gain = scores[:, 1:].max(1) - scores[:, 0] + 2 * move
        open_ = np.maximum.reduceat(gain, starts) > 0
        if open_.any():
            self._decode(scores, starts[open_], lengths[open_], out)
        return out

    def _decode(self, scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, out: np.ndarray) -> None:
        """Viterbi, the longest sentences first: at each step the ones that still go on are a prefix."""
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        steps = int(lengths[0])
        going = np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")
        best = self.begin + scores[starts]
        back = []
        for t in range(1, steps):
            n = going[t]
            ways = best[:n, :, None] + self.follow
            came = ways.argmax(1).astype(np.int8)
            back.append(came)
            best[:n] = np.take_along_axis(ways, came[:, None, :].astype(np.intp), 1)[:, 0] + scores[starts[:n] + t]
        label = best.argmax(1)
        for t in range(steps - 1, -1, -1):
            n = going[t]
            out[starts[:n] + t] = label[:n]
            if t:
                label[:n] = np.where(lengths[:n] > t, back[t - 1][np.arange(n), label[:n]], label[:n])

    def spans(self, tokens: Tokens) -> list[tuple[int, int, int]]:
        """(start, kind, end) of what the labels mark."""
        label = self.labels(tokens)
        opens = np.flatnonzero((label > 0) & (label % 2 == 1))
        inside = (label > 0) & (label % 2 == 0)
        stops = np.flatnonzero(~np.append(inside[1:], False))
        last = stops[np.searchsorted(stops, opens)]
        return list(zip(tokens.starts[opens].tolist(), (label[opens] // 2).tolist(), tokens.ends[last].tolist()))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - most).sum(axis, keepdims=True)) + most).squeeze(axis)


def _expected(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, follow: np.ndarray, begin: np.ndarray):
    """Probabilities of each token's labels, expected transitions and expected beginnings."""
    count, steps = len(starts), int(lengths.max())
    live = np.arange(steps) < lengths[:, None]
    e = scores[np.where(live, starts[:, None] + np.arange(steps), 0)]
    ahead, behind = np.zeros_like(e), np.zeros_like(e)
    ahead[:, 0] = begin + e[:, 0]
    for t in range(1, steps):
        ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + follow, 1) + e[:, t]
    for t in range(steps - 2, -1, -1):
        more = _log_sum(follow + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where(live[:, t + 1, None], more, 0)
    whole = _log_sum(ahead[np.arange(count), lengths - 1], 1)
    chance = np.exp(ahead + behind - whole[:, None, None])
    moves = np.zeros_like(follow)
    for t in range(1, steps):
        on = live[:, t]
        if on.any():
            way = ahead[on, t - 1, :, None] + follow + (e[on, t] + behind[on, t])[:, None, :] - whole[on, None, None]
            moves += np.exp(way).sum(0)
    return chance[live], moves, chance[:, 0].sum(0)


def fit(rows: list[tuple[str, list[tuple[str, int, int]]]], kinds: tuple[str, ...] = FOUND_KINDS, seed: int = 11) -> Chain:
    """A chain from texts and their (kind, start, end) spans."""
    legal, may_begin = _legal(len(kinds))
    follow, begin = np.where(legal, 0.0, _NEVER), np.where(may_begin, 0.0, _NEVER)
    made = [tokens_of(text) for text, _ in rows]
    words, seen = np.unique(np.concatenate([np.zeros(0, np.uint64), *(t.words for t in made)]), return_counts=True)
    lexicon = words[(seen >= LEAST_WORD) & (words > 0)]
    # All rows as one table of tokens, a row never sharing a sentence with another.
    sentences, numbers, labels, at = 0, [], [], 0
    for tokens, (_, spans) in zip(made, rows):
        mine = np.zeros(len(tokens.starts), np.int64)
        for kind, start, end in spans:
            held = np.flatnonzero((tokens.starts >= start) & (tokens.ends <= end))
            if len(held) and kind in kinds:
                mine[held] = 2 + 2 * kinds.index(kind)
                mine[held[0]] -= 1
        labels.append(mine)
        numbers.append(tokens.sentence + sentences)
        sentences += int(tokens.sentence[-1]) + 1 if len(tokens.starts) else 0
    whole = Tokens(*(np.concatenate([getattr(t, f) for t in made] or [np.zeros(0, np.int64)]) for f in Tokens.__annotations__))
    whole.sentence = np.concatenate([*numbers, np.zeros(0, np.int64)])
    ids, size = _features(whole, lexicon)
    weights = np.zeros((size, len(begin)))
    if not sentences:
        weights[:, _OUTSIDE] = 1.0
        return Chain(kinds, lexicon, weights.astype(np.float32), follow.astype(np.float32), begin.astype(np.float32))
    ids, truth = np.stack(ids, 1), np.concatenate(labels)
    starts = np.flatnonzero(np.diff(whole.sentence, prepend=-1))
    lengths = np.diff(np.append(starts, len(truth)))
    draw = np.random.default_rng(seed)
    seen_w, seen_f, seen_b = np.full_like(weights, 1e-3), np.full_like(follow, 1e-3), np.full_like(begin, 1e-3)
    for _ in range(EPOCHS):
        shuffled = draw.permutation(len(starts))
        for k in range(0, len(shuffled), SENTENCES_PER_STEP):
            chosen = shuffled[k : k + SENTENCES_PER_STEP]
            size_of = lengths[chosen]
            own = np.concatenate([np.arange(s, s + n) for s, n in zip(starts[chosen].tolist(), size_of.tolist())])
            heads = np.concatenate([[0], np.cumsum(size_of)[:-1]])
            used, back = np.unique(ids[own], return_inverse=True)
            back = back.reshape(len(own), -1)
            chance, moves, first = _expected(weights[used][back].sum(1), heads, size_of, follow, begin)
            y = truth[own]
            chance[np.arange(len(own)), y] -= 1
            slope = np.zeros((len(used), len(begin)))
            np.add.at(slope, back, chance[:, None, :])
            linked = np.ones(len(own), bool)
            linked[heads] = False
            np.add.at(moves, (y[np.flatnonzero(linked) - 1], y[linked]), -1)
            np.add.at(first, y[heads], -1)
            for value, grad, seen_ in ((follow, moves, seen_f), (begin, first, seen_b)):
                seen_ += grad**2
                value -= RATE * grad / np.sqrt(seen_)
            slope += PENALTY * len(chosen) * weights[used]
            seen_w[used] += slope**2
            weights[used] -= RATE * slope / np.sqrt(seen_w[used])
            follow[~legal], begin[~may_begin] = _NEVER, _NEVER
    return Chain(kinds, lexicon, weights.astype(np.float32), follow.astype(np.float32), begin.astype(np.float32))


# ---- the labelled table ----
_FIRST = "Anna Maria John Peter Lena Paul Julia Thomas Sofia Lucas Emma David Claire Hugo Elena Pablo Ingrid Oscar Nadia Felix".split()
_LAST = "Lopez Smith Miller Schneider Dubois Moreau Garcia Fischer Weber Martin Rossi Novak Brown Keller Bernard Ruiz Hansen Olsen".split()
_PLACES = "Baker Oak Mill Church Garden Station Park Lake River Hill Queen King".split()
_TITLES = "Mr {0}|Mrs {0}|Ms {0}|Dr. {0}|Prof. {0}|Herr {0}|Frau {0}|Monsieur {0}|Madame {0}|Señor {0}|Señora {0}"
_ROWS = {
    "person": f"My name is {{0}}.|I am {{0}} and work here|Please contact {{0}} for details.|Dear {{0}},|Sincerely, {{0}}|Patient: {{0}}"
    f"|Name: {{0}}|Signed by {{0}}|Mein Name ist {{0}}.|Je m'appelle {{0}}.|Me llamo {{0}}.|Nombre: {{0}}|Nom : {{0}}|{_TITLES}",
    "address": "I live at {0}.|Address: {0}|Please send it to {0}.|My home is {0}|Ich wohne in der {0}.|Anschrift: {0}|J'habite {0}."
    "|Adresse : {0}|Vivo en {0}.|Dirección: {0}|delivered to {0} yesterday",
    "birth": "I was born on {0}.|Date of birth: {0}|DOB {0}|born {0} in the north|geboren am {0}|Geburtsdatum: {0}|né le {0}|née le {0}"
    "|Date de naissance : {0}|nacido el {0}|nacida el {0}|Fecha de nacimiento: {0}",
    "idnum": "Passport number {0}|Passport no. {0}|SSN: {0}|My SSN is {0}.|IBAN {0}|IBAN: {0}|Tax id {0}|Licence number: {0}"
    "|Ausweisnummer {0}|Reisepass Nr. {0}|Numéro de passeport {0}|DNI {0}|Pasaporte {0}",
    "contact": "Call me on {0}.|Call {0} today|Tel: {0}|Tel. {0}|Phone: {0}|Telefon {0}|Téléphone : {0}|Teléfono: {0}|my number is {0}"
    "|Fax {0}|text me at {0} please",
    "mail": "Write to {0}.|mail me at {0}|Email: {0}|E-Mail: {0}|reach us under {0} any time|Courriel : {0}|Correo: {0}",
    "": "The meeting is on {date}.|in {year} there were {num} of them|version {digit}.{digit}.{digit} is out|page {digit} of {num}"
    "|order number {num}|Chapter {digit}: {word} and {word}|it cost {num}.{digit} per unit|at {digit}:30 we left {word}"
    "|The {word} of {Word} was {num} years old.|call the {word} function with {digit} arguments|the name of the {word} is {word}"
    "|{Word} {Word} {word}|see table {digit}, row {num}|{num} {num} {num}|write to the {word} at once|the address of the {word}"
    "|born of {word} and {word}|a number of {word}|copyright {year} by the {word}|{Word}: {word} {word} {word}",
}
_SYLLABLES = "the on re ti ha en er an or es ly ed ing ble tion wh th ou st nd ver ge sch ü ä keit le de eau ê ç ment ci ón que".split()


def _word(draw: random.Random) -> str:
    return "".join(draw.choice(_SYLLABLES) for _ in range(draw.randint(1, 4)))


def _digits(draw: random.Random, n: int) -> str:
    return "".join(draw.choice("0123456789") for _ in range(n))


def _date(draw: random.Random) -> str:
    day, year = draw.randint(1, 28), draw.randint(1930, 2015)
    month = draw.choice("January February March April June July September Januar März Mai juin août octubre mayo".split())
    number = draw.randint(1, 12)
    return draw.choice(
        [f"{day} {month} {year}", f"{month} {day}, {year}", f"{day}.{number}.{year}", f"{year}-{number:02}-{day:02}", f"{day:02}/{number:02}/{year}"]
    )


def _filled(draw: random.Random, kind: str) -> str:
    letters = "ABCDEFGHKLMNPRSTXYZ"
    made = _word(draw).title()
    first, last = draw.choice([*_FIRST, made]), draw.choice([*_LAST, _word(draw).title()])
    if kind == "person":
        return draw.choice([f"{first} {last}", f"{first} {last}", f"{first} {draw.choice(letters)}. {last}", f"{last}"])
    if kind == "address":
        place, number = draw.choice([*_PLACES, made]), draw.randint(1, 240)
        return draw.choice(
            [f"{number} {place} Street", f"{number} {place} Avenue", f"{number} {place} Road", f"{place}straße {number}"]
            + [f"{place}weg {number}", f"{number} rue {first} {last}", f"Calle {last} {number}", f"{number} {place} Lane"]
        )
    if kind == "birth":
        return _date(draw)
    if kind == "idnum":
        a, b = draw.choice(letters), draw.choice(letters)
        return draw.choice(
            [f"{a}{_digits(draw, 8)}", f"{_digits(draw, 3)}-{_digits(draw, 2)}-{_digits(draw, 4)}", f"{_digits(draw, 8)}{a}", f"{a}{b}{_digits(draw, 7)}"]
            + [f"{a}{b}{_digits(draw, 2)} {_digits(draw, 4)} {_digits(draw, 4)} {_digits(draw, 4)} {_digits(draw, 4)}"]
        )
    if kind == "mail":
        at, dot = draw.choice([(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" AT ", " DOT ")])
        return f"{first.lower()}{draw.choice(['', '.' + last.lower(), str(draw.randint(1, 99))])}{at}{_word(draw)}{dot}{draw.choice(['com', 'org', 'net', 'de', 'fr'])}"
    area = _digits(draw, 3)
    return draw.choice(
        [f"{area}-{_digits(draw, 4)}", f"({area}) {_digits(draw, 3)}-{_digits(draw, 4)}", f"{area} {_digits(draw, 7)}", f"{area}-{_digits(draw, 3)}-{_digits(draw, 4)}"]
        + [f"0{area}/{_digits(draw, 7)}", f"0{draw.randint(1, 9)} " + " ".join(_digits(draw, 2) for _ in range(4))]
    )


def labelled_rows(repeats: int = 10, seed: int = 5) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The labelled table: patterns of rows, filled by a rule; and rows of plain words."""
    draw, out = random.Random(seed), []
    for kind, patterns in _ROWS.items():
        for pattern in patterns.split("|"):
            for _ in range(repeats):
                lead = f"{_word(draw).title()} {_word(draw)} {_word(draw)}, " if draw.random() < 0.4 else ""
                tail = f" {_word(draw)} {_word(draw)}." if draw.random() < 0.5 else ""
                if kind:
                    filled = _filled(draw, kind)
                    before, after = pattern.split("{0}")
                    start = len(lead) + len(before)
                    span = ("contact" if kind == "mail" else kind, start, start + len(filled))
                    out.append((lead + before + filled + after + tail, [span]))
                else:
                    fields = {"date": _date(draw), "year": draw.randint(1800, 2030), "num": draw.randint(1, 10 ** draw.randint(2, 16))}
                    fields |= {"digit": draw.randint(1, 20), "word": _word(draw), "Word": _word(draw).title()}
                    out.append((lead + pattern.format(**fields) + tail, []))
    for _ in range(40 * repeats):
        words = [_word(draw) for _ in range(draw.randint(2, 18))]
        words[0] = words[0].title()
        if draw.random() < 0.3:
            at = draw.randrange(len(words))
            words[at] = draw.choice([words[at].title(), words[at].upper(), _digits(draw, draw.randint(1, 16)), words[at] + ","])
        out.append((" ".join(words) + draw.choice([".", "", "!"]), []))
    for _ in range(15 * repeats):
        said = draw.choice([*_SYLLABLES, _word(draw), _word(draw)])
        said = draw.choice([said, said.title(), said.title()])
        again = " ".join([said] * draw.randint(2, 14))
        short = draw.choice(_SYLLABLES)
        out.append((draw.choice([again, f"{_word(draw)}. {again} {short} {short}", f"{short} {short}. {said.title()} {_word(draw)} {short}"]), []))
    return out


def labelled_table(spark: SparkSession, repeats: int = 10, seed: int = 5) -> DataFrame:
    """(text, spans) to train on."""
    return spark.createDataFrame(labelled_rows(repeats, seed), f"text string, spans array<{SPAN}>")


def train(labelled: DataFrame, rows: int = TRAIN_ROWS, kinds: tuple[str, ...] = FOUND_KINDS) -> Chain:
    """Fit on at most ``rows`` rows of (text, spans), those with the least hash of their text."""
    chosen = labelled.select("text", "spans").filter("text IS NOT NULL").orderBy(F.xxhash64("text"), "text").limit(rows)
    made = [(r["text"], [tuple(s) for s in r["spans"] or []]) for r in chosen.collect()]
    return fit(made, kinds)


# ---- whole tables ----
def _all_spans(chain: Chain, texts: list[str]) -> list[list[dict]]:
    names = [*BASE_KINDS, *chain.kinds]
    tokens = tokens_of("\n".join(texts))
    found = chain.spans(tokens)
    lengths = np.array([len(t) + 1 for t in texts])
    heads = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    owner = np.searchsorted(heads, [s for s, _, _ in found], side="right") - 1
    more: dict[int, list[tuple[int, int, int]]] = {}
    for (start, kind, end), k in zip(found, owner.tolist()):
        head = int(heads[k])
        more.setdefault(k, []).append((start - head, len(BASE_KINDS) + kind, end - head))
    out = []
    for k, text in enumerate(texts):
        spans = base_spans(text)
        if k in more:
            spans = sorted(spans + _apart(more[k], spans))
        out.append([{"kind": names[kind], "start": start, "end": end} for start, kind, end in spans])
    return out


def _apart(spans: list[tuple[int, int, int]], others: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that no other overlaps; both are in order."""
    # Patterns of different kinds may overlap each other, so ends need not rise: merge them first.
    merged: list[list[int]] = []
    for start, _, end in others:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    kept, k = [], 0
    for span in spans:
        while k < len(merged) and merged[k][1] <= span[0]:
            k += 1
        if k == len(merged) or span[2] <= merged[k][0]:
            kept.append(span)
    return kept


_SPANS_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(shared):
    def scan(batches):
        chain: Chain = shared.value
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            spans: list[list[dict]] = []
            while len(spans) < len(texts):
                took, chars = len(spans), 0
                while took < len(texts) and (chars == 0 or chars + len(texts[took]) <= CHARS_AT_ONCE):
                    chars += len(texts[took]) + 1
                    took += 1
                spans += _all_spans(chain, texts[len(spans) : took])
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(spans, _SPANS_TYPE)], names=[*kept, "spans"]
            )

    return scan


def find_personal(docs: DataFrame, chain: Chain, text_col: str = "text", **keep) -> DataFrame:
    """The ``keep`` columns of each document and its ``spans`` by start, then kind."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(*(c.alias(n) for n, c in keep.items()), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        _scan(spark.sparkContext.broadcast(chain)), with_fields(rows, [*keep], f"spans array<{SPAN}>")
    )
