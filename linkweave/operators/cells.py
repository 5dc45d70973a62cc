"""Address features of all pairs of a cell: rows of S1 and of the pool that share a key and a deal meet in one task, and pairs leave it as lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from linkweave.functions.similarity import Many

#: Pool rows that an S1 row meets at once, pairs that a task hands out at once, and kinds of pairs that it gathers before equal ones become one.
MOST_MET, GIVEN_OUT, MOST_KINDS = 8_192, 1 << 16, 1 << 18
#: What a cell gives for a pair: three flags and three scores.
FLAGS, SCORES = ("both_have_address", "exact_street_num_match", "exact_pincode_match"), ("address_jaro", "address_token_set_ratio", "address_token_sort_ratio")

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _ODD[4]
    return x ^ (x >> np.uint64(29))


class _Piece:
    """Some pool rows of a cell."""

    def __init__(self, rows: pa.Table):
        self.ids = rows.column("cand_id").combine_chunks()
        self.claims = rows.column("claims").to_numpy()
        texts = rows.column("address").combine_chunks().dictionary_encode()
        self.many, self.text = Many(texts.dictionary.to_pylist()), texts.indices.to_numpy()
        self.known = np.array([s != "" for s in self.many.strings], bool)[self.text]
        self.street, self.pin = (rows.column(c).combine_chunks().dictionary_encode() for c in ("street", "pin"))
        self.codes = [({s: i for i, s in enumerate(x.dictionary.to_pylist())}, x.indices.to_numpy()) for x in (self.street, self.pin)]
        self.last = None
        tags = rows.column("tags").combine_chunks()
        self.tag_of = np.repeat(np.arange(len(tags)), pc.list_value_length(tags).to_numpy(zero_copy_only=False))
        flat = tags.flatten().dictionary_encode()
        self.tag_names, self.tags = {s: i for i, s in enumerate(flat.dictionary.to_pylist())}, flat.indices.to_numpy()

    def state(self, which: int, own: str) -> np.ndarray:
        """1 equal, 0 different, -1 if either is empty."""
        names, codes = self.codes[which]
        if own == "":
            return np.full(len(codes), -1, np.int8)
        out = (codes == names.get(own, -1)).astype(np.int8)
        if "" in names:
            out[codes == names[""]] = -1
        return out

    def features(self, address: str, street: str, pin: str) -> list[np.ndarray]:
        """Flags and scores for each row."""
        if self.last is None or self.last[0] != address:
            both = self.known.astype(np.int8) if address != "" else np.zeros(len(self.text), np.int8)
            self.last = address, (both, [x[self.text] for x in self.many.of(address)])
        both, scores = self.last[1]
        return [both, self.state(0, street), self.state(1, pin), *scores]

    def shared(self, tags: list) -> np.ndarray:
        """1 where a row has one of ``tags``."""
        out = np.zeros(len(self.text), np.int8)
        for x in tags:
            if x in self.tag_names:
                out[self.tag_of[self.tags == self.tag_names[x]]] = 1
        return out

    def kinds(self, found: list[np.ndarray]) -> np.ndarray:
        """A digest of claims, flags and scores for each row."""
        flags = (found[0] + np.int8(1)).astype(np.uint64) | (found[1] + np.int8(1)).astype(np.uint64) << np.uint64(2) | (found[2] + np.int8(1)).astype(np.uint64) << np.uint64(4)
        h = _mixed(flags * _ODD[0] + self.claims.view(np.uint64))
        for x, odd in zip(found[3:], _ODD[1:4], strict=True):
            h = _mixed((h ^ x.view(np.uint64)) * odd)
        return h


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int, pa.Table]]:
    """Rows in order of key, deal and side, cut where one of these changes and at the ends of batches."""
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = [batch.column("key").dictionary_encode().indices.to_numpy(), batch.column("deal").to_numpy(), batch.column("side").to_numpy()]
        cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in codes], axis=0)) + 1 if batch.num_rows > 1 else []
        table = pa.Table.from_batches([batch])
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield (batch.column("key")[lo].as_py(), int(codes[1][lo])), int(codes[2][lo]), table.slice(lo, hi - lo)


class Cells:
    """What mapInArrow runs. ``what``: pairs (their flags and scores), kinds (of each cell the distinct rows of features, with target, group and number of pairs) or scored (target and p of pairs, from rows of side 1 with the p of the cell's kinds)."""

    def __init__(self, what: str):
        self.what, self.most_met, self.given_out, self.most_kinds = what, MOST_MET, GIVEN_OUT, MOST_KINDS

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, pool, pieces, self.known = None, [], None, []
        self.own, self.lists, self.given, self.gathered, self.many = [], [], 0, [], 0
        for now, side, rows in _runs(batches):
            if now != cell:
                yield from self.ended(cell)
                cell, pool, pieces, self.known = now, [], None, []
            if side == 0:
                pool.append(rows.select(["cand_id", "claims", "address", "street", "pin", "tags"]))
                continue
            if side == 1:
                self.known.append((np.concatenate([np.asarray(x, np.int64) for x in rows.column("hashes").to_pylist()]), np.concatenate([np.asarray(x, float) for x in rows.column("ps").to_pylist()])))
                continue
            if not pool:
                continue
            if pieces is None:
                whole = pa.concat_tables(pool)
                pieces = [_Piece(whole.slice(i, self.most_met)) for i in range(0, len(whole), self.most_met)]
                self.sorted()
            columns = [rows.column(c).to_pylist() for c in ("address", "street", "pin", "tags", "kind", "group_of")]
            owns = rows.column("own").combine_chunks()
            for n, (address, street, pin, tags, kind, group) in enumerate(zip(*columns, strict=True)):
                for piece in pieces:
                    found = piece.features(address, street, pin)
                    target = piece.shared(tags) if self.what != "pairs" else None
                    if self.what == "kinds":
                        self.gather(piece, found, target, kind, group, owns[n : n + 1])
                        continue
                    given = found
                    if self.what == "scored":
                        given = [target, self.p_of(piece.kinds(found), kind)]
                    self.own.append(owns[n : n + 1])
                    self.lists.append((piece, given))
                    self.given += len(target if target is not None else found[0])
                    if self.given >= self.given_out:
                        yield self.out()
            if self.many >= self.most_kinds:
                self.one_of_each()
        yield from self.ended(cell)

    def ended(self, cell) -> Iterator[pa.RecordBatch]:
        if self.lists:
            yield self.out()
        if self.gathered:
            yield self.kinds_out(cell)

    def out(self) -> pa.RecordBatch:
        at = pa.array(np.cumsum([0, *[len(p.ids) for p, _ in self.lists]]), pa.int32())
        listed = lambda x: pa.ListArray.from_arrays(at, x)
        columns = [pa.concat_arrays(self.own), listed(pa.concat_arrays([p.ids for p, _ in self.lists]))]
        names = ["own", "cand_ids"]
        if self.what == "pairs":
            columns.append(listed(pa.array(np.concatenate([p.claims for p, _ in self.lists]))))
            names += ["claims", *FLAGS, *SCORES]
        else:
            names += ["targets", "ps"]
        for i in range(len(self.lists[0][1])):
            columns.append(listed(pa.array(np.concatenate([x[i] for _, x in self.lists]))))
        self.own, self.lists, self.given = [], [], 0
        return pa.RecordBatch.from_arrays(columns, names)

    def gather(self, piece: _Piece, found: list[np.ndarray], target: np.ndarray, kind: int, group: int, own: pa.Array) -> None:
        """The distinct kinds of an S1 row's pairs: (digest, target and group, number, features)."""
        h = _mixed(piece.kinds(found) ^ np.int64(kind).view(np.uint64)) >> np.uint64(2)
        _, first, number = np.unique(h << np.uint64(1) | target.astype(np.uint64), return_index=True, return_counts=True)
        self.gathered.append([h[first].view(np.int64), target[first], np.full(len(first), group, np.int32), number, np.full(len(first), len(self.own), np.int64), piece.claims[first], *[x[first] for x in found]])
        self.own.append(own)
        self.many += len(first)

    def one_of_each(self) -> None:
        columns = [np.concatenate(x) for x in zip(*self.gathered, strict=True)]
        order = np.lexsort((columns[2], columns[1], columns[0]))
        columns = [x[order] for x in columns]
        new = np.flatnonzero(np.concatenate([[True], np.any([x[1:] != x[:-1] for x in columns[:3]], axis=0)]))
        number = np.add.reduceat(columns[3], new)
        columns = [x[new] for x in columns]
        columns[3] = number
        used, columns[4] = np.unique(columns[4], return_inverse=True)
        self.own = [pa.concat_arrays(self.own).take(pa.array(used))]
        self.own = [self.own[0][i : i + 1] for i in range(len(used))]
        self.gathered, self.many = [columns], 0

    def kinds_out(self, cell) -> pa.RecordBatch:
        self.one_of_each()
        (columns,) = self.gathered
        own = pa.concat_arrays(self.own).take(pa.array(columns[4]))
        n = len(columns[0])
        arrays = [pa.array([cell[0]], pa.binary()).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, cell[1], np.int32)), own, *[pa.array(x) for i, x in enumerate(columns) if i != 4]]
        self.own, self.gathered, self.many = [], [], 0
        return pa.RecordBatch.from_arrays(arrays, ["key", "deal", "own", "hash", "target", "group_of", "number", "claims", *FLAGS, *SCORES])

    def sorted(self) -> None:
        """The cell's kinds in order of their digests."""
        if self.known:
            h, p = (np.concatenate(x) for x in zip(*self.known, strict=True))
            order = np.argsort(h)
            self.hashes, self.ps = h[order], p[order]

    def p_of(self, kinds: np.ndarray, kind: int) -> np.ndarray:
        h = (_mixed(kinds ^ np.int64(kind).view(np.uint64)) >> np.uint64(2)).view(np.int64)
        some, at = np.unique(h, return_inverse=True)
        place = np.minimum(np.searchsorted(self.hashes, some), len(self.hashes) - 1)
        if (self.hashes[place] != some).any():
            raise ValueError("a pair's kind was not scored")
        return self.ps[place][at]
