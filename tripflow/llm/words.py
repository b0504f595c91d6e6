"""Encode whole texts with a subword tokenizer through a bounded dictionary of words.

Pre-tokens never span a blank between two non-blank characters, so a text is the
concatenation of its words' encodings. Arrow splits the words of a slice of texts and looks them up
in a dictionary that a worker keeps from slice to slice, ids beside it as one flat array. Only
words that are not in it become Python strings, and the tokenizer sees them in one run; numpy
puts the ids together. The dictionary is bounded in bytes; what was not used for longest goes.
"""

import itertools
import operator
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Ends of words that both vocabularies' patterns split from a letter or digit before them.
_ENDS = ".,*%$&#!|:;?"
_SLICE_BYTES = 4_000_000
_KEPT_BYTES = 32_000_000
_LONG_WORD = 64
_JOINED = 4096
_PREFIXES = ("", " ", "\n")
_FIRST, _SPACED, _LINE = range(3)
# White space or other control characters at an end of a word, or no word: more than needed.
_BLANKS = r"\x00-\x09\x0b-\x1f\x7f-\xa0\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}\x{3000}\x{feff}"
_HARD = rf"^(?:$|[{_BLANKS}]|[ \n](?:$|[ \n{_BLANKS}]))|[ \n{_BLANKS}]$"
# One pre-token of the byte-level pattern: letters (no others than in every Unicode version), a blank before them or not.
_LETTERS = r"^ ?[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{17f}]+$"
# The character that stands for each byte in byte-level vocabularies; these are not the Latin-1 ones.
_BYTE_CHARS = np.arange(256, dtype="<u2")
_BYTE_CHARS[[*range(33), *range(127, 161), 173]] = 256 + np.arange(68)


class TokenizerFile:
    """A file of the tokenizers library.

    ``specials``: its special strings, which it finds in a text before anything else, as by
    default; with ``plain`` they are ordinary text.
    """

    def __init__(self, path, plain=False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.specials = [] if plain else [content for content, _ in added]
        self.tokenizer.encode_special_tokens = plain
        self.separator = added[0] if added and not plain else None
        splitter = self.tokenizer.pre_tokenizer
        # Whether what stands before the model does nothing to letters but write their bytes as characters.
        self.byte_level = (
            self.tokenizer.normalizer is None and type(splitter).__name__ == "ByteLevel" and splitter.use_regex
            and not splitter.add_prefix_space and all(t.special for t in self.tokenizer.get_added_tokens_decoder().values())
        )
        self.model = self.tokenizer.model

    def texts(self, texts):
        """The ids of whole texts, flat, and how many each has."""
        return _flat([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def parts(self, parts):
        """The same for an Arrow array of parts without special strings. Words of letters go to the
        library's model at once, if the file is of the byte-level kind."""
        if not self.byte_level:
            return self._joined(parts)
        direct = pc.match_substring_regex(parts, _LETTERS).to_numpy(zero_copy_only=False)
        runs = [self._words(parts.filter(pa.array(direct))), self._joined(parts.filter(pa.array(~direct)))]
        flat, counts = (np.concatenate(column) for column in zip(*runs, strict=True))
        order = np.argsort(np.concatenate([np.flatnonzero(direct), np.flatnonzero(~direct)]))
        return take_runs(flat, (np.cumsum(counts) - counts)[order], counts[order]), counts[order]

    def _words(self, words):
        """The same for words that are one pre-token each."""
        tokenize, runs = self.model.tokenize, [_flat([])]
        for start in range(0, len(words), _JOINED):
            raw = "\n".join(words.slice(start, _JOINED).to_pylist()).encode()
            chars = _BYTE_CHARS[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-16-le")
            tokens = [tokenize(word) for word in chars.split(chr(_BYTE_CHARS[10]))]
            runs.append(_flat(tokens, operator.attrgetter("id")))
        return tuple(np.concatenate(column) for column in zip(*runs, strict=True))

    def _joined(self, parts):
        """Joined by a special string, which is a token of its own and keeps them apart, parts are a few texts."""
        if not len(parts):
            return _flat([])
        if self.separator is None:
            return self.texts(parts.to_pylist())
        content, number = self.separator
        bounds = np.append(np.arange(0, len(parts), _JOINED), len(parts)).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), parts), content).to_pylist()
        # One at a time: what the library keeps of a text besides its ids is many times as large.
        ids = np.concatenate([self.texts([content + text])[0] for text in joined])
        starts = np.flatnonzero(ids == number)
        return ids[ids != number], np.diff(np.append(starts, len(ids))) - 1


def _flat(lists, number=None):
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    items = itertools.chain.from_iterable(lists)
    return np.fromiter(map(number, items) if number else items, np.uint32, int(counts.sum())), counts


def text_slices(texts, most=_SLICE_BYTES):
    """Bounds of runs of texts of about ``most`` bytes; a longer text is a run of its own.

    After each run Arrow hands back what it no longer uses: workers live on between tasks.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(sizes):
        base = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield start, stop
        pa.default_memory_pool().release_unused()
        start = stop


def take_runs(flat, starts, lengths):
    """``flat[s : s + n]`` of all runs, one after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) - np.repeat(ends - lengths - starts, lengths)]


def _core(unit):
    """A unit without the marks at its end that the vocabularies' patterns split off."""
    core = unit.rstrip(_ENDS)
    return core if core and core[-1].isalnum() and len(core[-1].lower()) == 1 else unit


class WordEncoder:
    """``texts``: runs of texts to flat ids. ``coder``: has ``texts`` and ``parts`` (lists of texts to
    flat ids and counts) and ``specials``. ``spaced``: a blank belongs to the word after it
    (byte-level vocabularies); else blanks are dropped. ``fold``: applied to an array of words before
    they are encoded. ``limit``: bytes of words and ids kept between slices."""

    def __init__(self, coder, spaced, fold=None, limit=_KEPT_BYTES, run_bytes=_SLICE_BYTES):
        self.coder, self.spaced, self.fold, self.limit = coder, spaced, fold, limit
        self.run_bytes = run_bytes
        self.specials = list(coder.specials)
        self.slice_no = 0
        self._keep(pa.array([], pa.string()), np.zeros(0, np.uint32), *(np.zeros(0, t) for t in (np.int64, bool, np.int32)))

    def _keep(self, names, flat, lengths, hard, used):
        """The dictionary: names; their ids in ``flat``; whether white space stands at an end; last use."""
        self.names, self.flat, self.lengths, self.hard, self.used = names, flat, lengths, hard, used
        self.starts = np.cumsum(lengths) - lengths

    def _add(self, names, flat, lengths):
        hard = np.zeros(len(names), bool)
        if self.spaced:
            hard = pc.match_substring_regex(names, _HARD).to_numpy(zero_copy_only=False)
        self._keep(
            pa.concat_arrays([self.names, names]), np.concatenate([self.flat, flat]),
            np.concatenate([self.lengths, lengths]), np.concatenate([self.hard, hard]),
            np.concatenate([self.used, np.full(len(names), self.slice_no, np.int32)]),
        )

    def _find(self, units):
        """The place of each of some distinct strings in the dictionary, else -1. The fewer ones are
        hashed, mostly these."""
        if len(units) > len(self.names):
            return pc.index_in(units, value_set=self.names).fill_null(-1).to_numpy().astype(np.int64)
        found = pc.index_in(self.names, value_set=units).fill_null(-1).to_numpy()
        known = np.flatnonzero(found >= 0)
        at = np.full(len(units), -1, np.int64)
        at[found[known]] = known
        return at

    def _places(self, units):
        """The place of each of some distinct units in the dictionary; unknown ones are added to it."""
        at = self._find(units)
        unknown = at < 0
        if unknown.any():
            at[unknown] = self._learn(units.filter(pa.array(unknown)))
        return at

    def _learn(self, units):
        """Add units that are not known, and the parts they are put together from."""
        whole = self.fold(units) if self.fold else units
        cores = pc.utf8_rtrim(whole, _ENDS)
        plain = pc.match_substring_regex(cores, "[A-Za-z0-9]$").to_numpy(zero_copy_only=False)
        odd = np.flatnonzero(~plain & pc.not_equal(cores, whole).to_numpy(zero_copy_only=False))
        if len(odd):
            exact = pa.array([_core(u) for u in whole.take(pa.array(odd)).to_pylist()], pa.string())
            cores = pc.replace_with_mask(cores, pa.array(np.isin(np.arange(len(cores)), odd)), exact)
        # What is left of a unit after its core.
        cut = pc.binary_length(whole).to_numpy() - pc.binary_length(cores).to_numpy()
        ends = np.full(len(cores), "", object)
        tails = np.flatnonzero(cut)
        ends[tails] = [
            u[-n:] for u, n in zip(whole.take(pa.array(tails)).to_pylist(), cut[tails].tolist(), strict=True)
        ]
        coded = pa.concat_arrays([cores, pa.array(ends, pa.string())]).dictionary_encode()
        parts = coded.dictionary
        place = self._find(parts)
        fresh = place < 0
        unknown = parts.filter(pa.array(fresh))
        place[fresh] = len(self.names) + np.arange(len(unknown))
        if len(unknown):
            self._add(unknown, *self.coder.parts(unknown))
        both = place[coded.indices.to_numpy()].reshape(2, -1)
        # A unit that is a part by itself has its place already.
        same = pc.and_(pc.equal(cores, units), pc.equal(whole, units)).to_numpy(zero_copy_only=False)
        at, made = both[0].copy(), np.flatnonzero(~same)
        both = both[:, made].T.reshape(-1)
        at[made] = len(self.names) + np.arange(len(made))
        self._add(
            units.take(pa.array(made)), take_runs(self.flat, self.starts[both], self.lengths[both]),
            self.lengths[both].reshape(-1, 2).sum(axis=1),
        )
        return at

    def _forget(self):
        """Down to half of the limit, if it is passed: very long words first, then by last use."""
        name_bytes = pc.binary_length(self.names).to_numpy()
        size = name_bytes + 4 * self.lengths + 25
        if size.sum() <= self.limit:
            return
        order = np.lexsort((-self.used, name_bytes > _LONG_WORD))
        order = order[np.cumsum(size[order]) <= self.limit // 2]
        order.sort()
        self._keep(
            self.names.take(pa.array(order)), take_runs(self.flat, self.starts[order], self.lengths[order]),
            self.lengths[order], self.hard[order], self.used[order],
        )

    def _slice(self, texts):
        self.slice_no += 1
        odd = self._special(texts)
        lines = pc.split_pattern(pc.if_else(pa.array(odd), "", texts) if odd.any() else texts, "\n")
        words = pc.split_pattern(lines.flatten(), " ")
        line_at, word_at = lines.offsets.to_numpy(), words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        code = coded.indices.to_numpy()
        text_at = word_at[line_at]
        units = coded.dictionary
        if self.spaced:
            size = len(units)
            kind = np.full(len(code), size * _SPACED, np.int32)
            kind[word_at[:-1]] = size * _LINE
            kind[text_at[:-1]] = size * _FIRST
            code = code + kind
            flags = np.zeros(size * 3, bool)
            flags[code] = True
            used = np.flatnonzero(flags)
            place = np.zeros(size * 3, np.int32)
            place[used] = np.arange(len(used), dtype=np.int32)
            code = place[code]
            prefix = pa.array(_PREFIXES).take(pa.array(used // size))
            units = pc.binary_join_element_wise(prefix, units.take(pa.array(used % size)), "")
        at = self._places(units)
        self.used[at] = self.slice_no
        unit = at[code]
        word_lengths = self.lengths[unit]
        ids = take_runs(self.flat, self.starts[unit], word_lengths)
        at = np.concatenate([[0], np.cumsum(word_lengths)])[text_at]
        if self.spaced:
            odd |= np.diff(np.concatenate([[0], np.cumsum(self.hard[unit])])[text_at]) > 0
        self._forget()
        if not odd.any():
            return ids, np.diff(at)
        flat, counts = self.coder.texts(texts.filter(pa.array(odd)).to_pylist())
        whole = dict(zip(np.flatnonzero(odd).tolist(), np.split(flat, np.cumsum(counts)[:-1]), strict=True))
        runs = [whole[i] if i in whole else ids[at[i]:at[i + 1]] for i in range(len(texts))]
        return np.concatenate(runs), np.array([len(r) for r in runs], np.int64)

    def _special(self, texts):
        """Which texts hold a special string, or one that folding would make; they are encoded as a whole."""
        odd = np.zeros(len(texts), bool)
        for content in self.specials:
            odd |= pc.match_substring(texts, content, ignore_case=self.fold is not None).to_numpy(zero_copy_only=False)
        return odd

    def texts(self, texts):
        """Yield ``(start, stop, ids, counts)`` for runs of an Arrow array of texts; null is empty."""
        for start, stop in text_slices(texts, self.run_bytes):
            run = pa.array(texts.slice(start, stop - start).fill_null(""))
            yield start, stop, *self._slice(run)
