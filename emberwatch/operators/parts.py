"""Greedy packing of lines into parts, one shard of a message at a time.

Between lines the packer knows only the length of the open part, a whole number up to
the limit. A shard can therefore be worked through for all lengths at once, before it is
known with which of them it begins. Running totals of the line lengths make every part a
single look-up, whatever the number of its lines.
"""

import numpy as np
import pandas as pd


def _measured(rows, limit):
    """The lines of a shard in order, over-long ones cut; running totals; next line with text.

    A line costs its length and one line break. Both arrays have one entry more than lines.
    """
    lines = []
    for text in rows.sort_values("block")["text"]:
        for line in (text + "\n").splitlines():
            if len(line) <= limit:
                lines.append(line)
            else:
                lines += [line[start : start + limit] for start in range(0, len(line), limit)]
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    totals = np.r_[0, np.cumsum(lengths + 1)]
    places = np.where(np.r_[lengths, 1] > 0, np.arange(len(lines) + 1), len(lines))
    return lines, totals, np.minimum.accumulate(places[::-1])[::-1]


def _end(totals, room):
    """The first line that no longer fits when the lines before may cost ``room``."""
    return np.searchsorted(totals, room, side="right") - 1


def trace_lengths(key, rows, limit):
    """For every entry length: the length the shard leaves and the parts it closes.

    Written as runs: ``entry`` is the first length of a run. A part begins at a line with
    text, so blank lines at its start vanish.
    """
    rank, shard = key
    lines, totals, solid = _measured(rows, limit)
    count = len(lines)
    entries = np.arange(1 if shard == 0 else limit + 1)
    ends = _end(totals, limit - entries)
    ends[0] = 0  # nothing is open
    closed = (ends < count).astype(np.int64)
    closed[0] = 0
    leaves = np.where(ends < count, 0, entries + totals[count])
    # Entry lengths that begin their next part at the same line go on together.
    begins, member = np.unique(np.where(ends < count, solid[ends], count), return_inverse=True)
    more, left = np.zeros_like(begins), np.zeros_like(begins)
    open_ = begins < count
    while open_.any():
        ends = _end(totals, limit + 1 + totals[begins])
        left = np.where(open_ & (ends == count), totals[count] - totals[begins] - 1, left)
        full = open_ & (ends < count)
        more += full
        begins = np.where(full, solid[ends], count)
        open_ = begins < count
    leaves, closed = leaves + left[member], closed + more[member]
    starts = np.flatnonzero(np.r_[True, (np.diff(leaves) != 0) | (np.diff(closed) != 0)])
    return pd.DataFrame(
        {"severity_rank": rank, "shard": shard, "entry": starts, "leaves": leaves[starts], "closed": closed[starts]}
    )


def _run_at(runs, lengths):
    """For each entry length the run that it belongs to."""
    return runs.iloc[np.searchsorted(runs["entry"].to_numpy(), lengths, side="right") - 1]


def compose_shards(key, runs):
    """The runs of several neighbouring shards taken as one.

    All lengths of a run of the first shard leave the same length, so it has one run at most
    for each of them, however many shards follow.
    """
    rank, node = key
    whole = None
    for _, own in runs.sort_values(["shard", "entry"]).groupby("shard"):
        if whole is None:
            whole = own[["entry", "leaves", "closed"]].reset_index(drop=True)
            continue
        onward = _run_at(own, whole["leaves"].to_numpy())
        whole = whole.assign(leaves=onward["leaves"].to_numpy(), closed=whole["closed"].to_numpy() + onward["closed"].to_numpy())
    new = (whole["leaves"].diff() != 0) | (whole["closed"].diff() != 0)
    return whole[new].assign(severity_rank=rank, shard=node)[["severity_rank", "shard", "entry", "leaves", "closed"]]


def enter_shards(key, runs, start):
    """With which length and part each of several neighbouring shards begins, from how the first
    of them does. ``start`` is empty above the first shard of all."""
    length, part = (int(start[name].iloc[0]) for name in ("entry", "part")) if len(start) else (0, 1)
    found = []
    for shard, own in runs.sort_values(["shard", "entry"]).groupby("shard"):
        found.append((key[0], shard, length, part))
        run = _run_at(own, [length]).iloc[0]
        length, part = int(run["leaves"]), part + int(run["closed"])
    table = pd.DataFrame(found, columns=["severity_rank", "shard", "entry", "part"])
    parts = int(start["parts"].iloc[0]) if len(start) else part if length else part - 1
    return table.assign(parts=parts)


def pack_fragments(key, rows, start, limit):
    """The text a shard adds to each part it touches.

    A fragment that goes on with a part opened before begins with the line break.
    """
    rank, shard = key
    lines, totals, solid = _measured(rows, limit)
    length, part, parts = (int(start[name].iloc[0]) for name in ("entry", "part", "parts"))
    found, begin = [], solid[0]
    if length:
        end = _end(totals, limit - length)
        found.append((part, "".join("\n" + line for line in lines[:end])))
        begin, part = solid[end], part + 1
    while begin < len(lines):
        end = _end(totals, limit + 1 + totals[begin])
        found.append((part, "\n".join(lines[begin:end])))
        begin, part = solid[end], part + 1
    table = pd.DataFrame(found, columns=["part", "text"])
    table = table.assign(severity_rank=rank, parts=parts, shard=shard)
    return table.loc[table["text"] != "", ["severity_rank", "part", "parts", "shard", "text"]]
