"""BPE encoding and decoding by one last token per prefix.

For every prefix of a word exactly one token can be the last of that prefix's encoding. Walking the
prefixes from left to right, the candidates are the tokens that end there, found by following an
automaton of the reversed vocabulary backwards; the one kept is compatible with the last token of the
prefix before it. Two tokens are compatible when no merge across their border would have come
before the merges that build them. Following the stored tokens back from the end gives the ids.

Texts are cut into words as the vocabulary file declares it: NFC, lower case, white space dropped,
letters, single digits and other runs, contractions apart. What is a letter, a number, a mark or a
capital is as in the tokenizers library, whose Unicode version is not that of Python. Words repeat, so
each task keeps the encodings it has met, up to a bound.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.llm.runtime import map_batches, ship

#: Encodings a task remembers.
REMEMBERED = 500_000

_END = "\x00"
_ODD_SPACES = regex.compile("[\x1c-\x1f]")
_tables: dict[str, "Tables"] = {}

# Where the Unicode tables of the tokenizers library differ from those of Python and regex.
#: Code points (hexadecimal) that are letters, and that are numbers, in later versions only.
LATER_LETTERS = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF "
    "10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 "
    "187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 "
    "1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
LATER_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"
#: Marks that the library's NFC, being of an earlier version, neither reorders, composes nor passes over.
LATER_MARKS = (
    "07FD 0898-089F 08CA-08D3 09FE 0C3C 0D3B-0D3C 0EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC "
    "10EFD-10EFF 10F46-10F50 10F82-10F85 11070 1133B 1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 "
    "11A99 11D42 11D44-11D45 11D97 11F41-11F42 16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF"
)
#: Capitals that the library makes small: first, last, and the distance to the small letter.
CAPITALS = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
)


def characters(ranges: str) -> str:
    """What stands between the brackets of a pattern for hexadecimal code points and ranges of them."""
    return "".join("-".join(rf"\U{int(end, 16):08X}" for end in part.split("-")) for part in ranges.split())


_LATER = regex.compile(f"[{characters(LATER_LETTERS)}{characters(LATER_NUMBERS)}]")
_MARKS = regex.compile(f"([{characters(LATER_MARKS)}])")
_SMALL_LETTERS = re.compile("[a-z]+")
#: The first listed mark or capital is U+07FD.
_LISTED = re.compile("[\u07fd-\u1fff\ua000-\U0010ffff]")
_SMALL = {c: c + step for first, last, step in CAPITALS for c in range(first, last + 1)}


def composed(text: str) -> str:
    """NFC of the library's Unicode version: marks that it lacks stand between parts that are composed apart."""
    if not _MARKS.search(text):
        return unicodedata.normalize("NFC", text)
    return "".join(unicodedata.normalize("NFC", part) for part in _MARKS.split(text))


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else 256 and up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = [""] * 256, 256
    for byte in range(256):
        if byte in shown:
            letters[byte] = chr(byte)
        else:
            letters[byte] = chr(spare)
            spare += 1
    return letters


class Tables:
    """Merge order, halves of each token, and the automaton of reversed tokens."""

    def __init__(self, definition: dict):
        model = definition["model"]
        suffix = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in definition["added_tokens"]}
        self.names.update({i: t for t, i in self.special.items()})
        patterns = definition["pre_tokenizer"]["pretokenizers"]
        pattern = next(p["pattern"]["Regex"] for p in patterns if p["type"] == "Split")
        self.pieces = regex.compile(pattern)
        earlier = pattern.replace(r"\p{L}", rf"[\p{{L}}--[{characters(LATER_LETTERS)}]]").replace(r"\p{N}", rf"[\p{{N}}--[{characters(LATER_NUMBERS)}]]")
        self.earlier_pieces = regex.compile(earlier, regex.V1)
        #: whether small letters of ASCII are one piece: what the pattern tries before a run of letters begins with an apostrophe
        before, run, _ = pattern.partition(r"[\p{L}]+")
        self.plain = bool(run) and all(p.startswith("'") for p in before.split("|")[:-1]) and before[-1:] in ("", "|")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.letters = byte_letters()
        #: rank of the merge of two tokens; made[t]: that of the merge that makes t, -1 for a single letter
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = dict.fromkeys(self.ids.values(), -1)
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = (self.ids[left], self.ids[right])
            whole = self.ids[left + right]
            self.rank[pair] = rank
            if self.made[whole] < 0:
                self.made[whole], self.halves[whole] = rank, pair
        #: a state holds, for each letter before it, the token that begins there (-1: none) and the next state
        self.root: dict[str, list] = {}
        for token, number in self.ids.items():
            end = token.endswith(suffix) and len(token) > len(suffix)
            text = token[: -len(suffix)] + _END if end else token
            if number in self.halves or len(text) - end == 1:
                state = self.root
                for letter in reversed(text):
                    step = state.setdefault(letter, [-1, {}])
                    state = step[1]
                step[0] = number
        self.end: dict[str, list] = self.root.get(_END, [-1, {}])[1]
        self.shown = {i: str(i) for i in self.names}
        #: ids and decoded tokens of text without white space, each as text; a special token's key has a space
        self.known_ids: dict[str, str] = {}
        self.known_text: dict[str, str] = {}
        self.fits: dict[tuple[int, int], bool] = {}

    def _apart(self, left: int, right: int) -> bool:
        used_left = used_right = len(self.rank)
        while True:
            merge = self.rank.get((left, right))
            # of equal merges the one further left comes first: inside the left token, then across
            if merge is not None and merge < used_left and merge <= used_right:
                return False
            made_left, made_right = self.made[left], self.made[right]
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                used_left, left = made_left, self.halves[left][1]
            else:
                used_right, right = made_right, self.halves[right][0]

    def pieces_ids(self, pieces: list[str]) -> dict[str, list[int]]:
        """Ids of pieces of text. In sorted order a piece takes over the prefixes it shares with the one before."""
        letters, root, fits = self.letters, self.root, self.fits
        if len(fits) > REMEMBERED:
            fits.clear()
        found: dict[str, list[int]] = {}
        before, last, back = "", [-1], [0]
        # the letters of printable ASCII are itself
        for text, piece in sorted((p if p.isascii() and p.isprintable() else "".join([letters[b] for b in p.encode()]), p) for p in pieces):
            n, shared = len(text), 0
            for x, y in zip(before, text):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], back[shared + 1 :]
            for stop in range(shared + 1, n + 2):
                whole = stop > n
                at = n if whole else stop
                state = self.end if whole else root
                token = -1
                while at:
                    at -= 1
                    step = state.get(text[at])
                    if step is None:
                        token = -1
                        break
                    token, state = step
                    if token >= 0:
                        if not at:
                            break
                        pair = (last[at], token)
                        fit = fits.get(pair)
                        if fit is None:
                            fit = fits[pair] = pair[0] >= 0 and self._apart(*pair)
                        if fit:
                            break
                if whole:
                    ids = [token]
                else:
                    last.append(token)
                    back.append(at)
            while at:
                ids.append(last[at])
                at = back[at]
            ids.reverse()
            found[piece], before = ids, text
        return found

    def learn(self, chunks: set[str]) -> None:
        """Encode the texts without white space that are not known yet."""
        known = self.known_ids
        whole = set(filter(_SMALL_LETTERS.fullmatch, chunks)) if self.plain else set()
        cut = {c: (self.earlier_pieces if not c.isascii() and _LATER.search(c) else self.pieces).findall(c) for c in chunks - whole}
        found = self.pieces_ids(list(whole.union([p for pieces in cut.values() for p in pieces if p not in known])))
        shown, names = self.shown.__getitem__, self.names.__getitem__
        ids = {p: " ".join(map(shown, made)) for p, made in found.items()}
        text = {p: " ".join(map(names, made)) for p, made in found.items()}
        for chunk, pieces in cut.items():
            text[chunk] = " ".join([text[p] if p in text else self.known_text[p] for p in pieces])
            ids[chunk] = " ".join([ids[p] if p in ids else known[p] for p in pieces])
        for chunk in chunks:
            known[chunk], self.known_text[chunk] = ids[chunk], text[chunk]

    def chunks(self, text: str | None) -> list[str]:
        """The text without white space, in order, and special tokens marked by a space."""
        found: list[str] = []
        for part in self.specials.split(text) if self.specials and text else (text or "",):
            if part in self.special:
                found.append(" " + part)
                self.known_ids[" " + part], self.known_text[" " + part] = str(self.special[part]), part
                continue
            if _LISTED.search(part):
                part = composed(part).replace("Σ", "σ").lower().translate(_SMALL)
            elif not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            else:
                part = part.lower()
            found.extend(part.split() if not _ODD_SPACES.search(part) else filter(None, regex.split(r"\s+", part)))
        return found

    def encode(self, texts: list[str | None]) -> list[tuple[str, str]]:
        """Ids joined by a space and decoded text, for each text."""
        if len(self.known_ids) > REMEMBERED:
            self.known_ids.clear()
            self.known_text.clear()
        parts = [self.chunks(t) for t in texts]
        self.learn({c for cs in parts for c in cs}.difference(self.known_ids))
        ids, text = self.known_ids.__getitem__, self.known_text.__getitem__
        return [(" ".join(map(ids, cs)), " ".join(map(text, cs))) for cs in parts]


def tables(definition: bytes) -> Tables:
    """The tables of a vocabulary file, built once per worker process."""
    key = hashlib.sha256(definition).hexdigest()
    if key not in _tables:
        _tables[key] = Tables(json.loads(definition))
    return _tables[key]


def encode(
    documents: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", full: bool = False
) -> DataFrame:
    """Token count and digests of ids and decoded text of every row; with ``full`` also both themselves.

    Columns: the id, n_tokens, ids_sha256, decoded_sha256, and with ``full`` ids (array) and decoded.
    A null or empty text has no tokens and the digests of the empty string. Repeated rows are each
    encoded; other columns of the input do not matter. ``vocabulary`` is read by the driver and
    broadcast; a vocabulary file has a fixed size.
    """
    spark = documents.sparkSession
    ship(spark)
    with open(vocabulary, "rb") as file:
        definition = spark.sparkContext.broadcast(file.read())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = tables(definition.value)
        rows = table.encode(batch.column(1).to_pylist())
        columns = [
            batch.column(0),
            pa.array([r[0].count(" ") + bool(r[0]) for r in rows], pa.int64()),
            pa.array([hashlib.sha256(r[0].encode()).hexdigest() for r in rows]),
            pa.array([hashlib.sha256(r[1].encode()).hexdigest() for r in rows]),
        ]
        names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if full:
            columns.append(pa.array([list(map(int, r[0].split())) for r in rows], pa.list_(pa.int32())))
            columns.append(pa.array([r[1] for r in rows]))
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(columns, names)

    schema = "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    rows = documents.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    made = map_batches(rows, run, schema + (", ids array<int>, decoded string" if full else ""))
    return made.withColumnRenamed("id", id_column)


def default_vocabulary() -> str:
    """The installed word vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary())
