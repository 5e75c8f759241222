"""Functions on token arrays: labels, masks, padding, positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORE = -100


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_to(a: Column | str, n: Column | int, value: int) -> Column:
    """Appends ``value`` up to n elements; longer arrays stay."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.concat(_col(a), F.array_repeat(F.lit(value), F.greatest(n - F.size(_col(a)), F.lit(0)).cast("int")))


def shift_inputs(a: Column | str) -> Column:
    return F.slice(_col(a), 1, F.greatest(F.size(_col(a)) - 1, F.lit(0)))


def shift_labels(a: Column | str) -> Column:
    return F.slice(_col(a), 2, F.greatest(F.size(_col(a)) - 1, F.lit(0)))


def mask_labels(labels: Column | str, mask: Column | str) -> Column:
    """Labels where the loss mask is not 0, else -100."""
    return F.zip_with(_col(labels), _col(mask), lambda x, m: F.when(m != 0, x).otherwise(F.lit(IGNORE)))


def prompt_mask(n_prompt: Column | int, n_total: Column | int) -> Column:
    """0 for the prompt's tokens, 1 for the rest."""
    n_prompt, n_total = (F.lit(x) if isinstance(x, int) else x for x in (n_prompt, n_total))
    return F.concat(F.array_repeat(F.lit(0), n_prompt.cast("int")), F.array_repeat(F.lit(1), F.greatest(n_total - n_prompt, F.lit(0)).cast("int")))


def last_supervised(labels: Column | str) -> Column:
    """1-based place of the last label that counts; 0 if none."""
    return F.coalesce(F.array_max(F.transform(_col(labels), lambda x, i: F.when(x != IGNORE, i + 1).otherwise(0))), F.lit(0))


def last_run_only(labels: Column | str) -> Column:
    """Only the last contiguous run of supervised labels stays."""
    end = last_supervised(labels)
    start = F.coalesce(F.array_max(F.transform(_col(labels), lambda x, i: F.when((x == IGNORE) & (i + 1 < end), i + 1).otherwise(0))), F.lit(0))
    return F.transform(_col(labels), lambda x, i: F.when((i + 1 > start) & (i + 1 <= end), x).otherwise(F.lit(IGNORE)))


def attention_from_labels(labels: Column | str) -> Column:
    """1 up to the last supervised label, then 0."""
    end = last_supervised(labels)
    return F.transform(_col(labels), lambda x, i: F.when(i + 1 <= end, 1).otherwise(0))


def last_content(ids: Column | str, pad: int) -> Column:
    """1-based place of the last token before the trailing padding; 0 if all is padding."""
    return F.coalesce(F.array_max(F.transform(_col(ids), lambda x, i: F.when(x != pad, i + 1).otherwise(0))), F.lit(0))


def padding_mask(ids: Column | str, pad: int, pad_is_eos: bool = False) -> Column:
    """1 for content: the trailing run of pad is 0, but its first token counts as content if pad is also the end token."""
    end = last_content(ids, pad) + (1 if pad_is_eos else 0)
    return F.transform(_col(ids), lambda x, i: F.when(i < end, 1).otherwise(0))


def positions(lengths: Column | str) -> Column:
    """Position ids that restart with each sequence."""
    return F.flatten(F.transform(_col(lengths), lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))))


def remaining(lengths: Column | str) -> Column:
    """How many tokens of its sequence come after each token."""
    return F.flatten(F.transform(_col(lengths), lambda n: F.when(n > 0, F.sequence(n - 1, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))))


def folded_positions(lengths: Column | str, size: int) -> Column:
    """Position ids of a pack of ``size``: padding goes on where the last sequence ends, at most to size - 1."""
    own, lens = positions(lengths), _col(lengths)
    pad = F.greatest(F.lit(size) - F.size(own), F.lit(0))
    last = F.coalesce(F.try_element_at(own, F.lit(-1)), F.lit(-1))
    more = F.transform(F.array_repeat(F.lit(0), pad), lambda x, j: F.least(last + 1 + j, F.lit(size - 1)))
    return F.when(F.size(lens) >= 0, F.concat(own, more))


def shift_for_left_pad(mask: Column | str, attention: Column | str) -> Column:
    """A mask made on unpadded tokens, moved right by the padding on the left; without padding or attention mask it stays."""
    m = _col(mask)
    content = F.aggregate(_col(attention), F.lit(0), lambda acc, x: acc + x.cast("int"))
    pad = F.greatest(F.size(m) - F.coalesce(content, F.size(m)), F.lit(0))
    return F.concat(F.array_repeat(F.lit(0), pad), F.slice(m, F.lit(1), F.size(m) - pad))


def segments(lengths: Column | str) -> Column:
    """1-based segment ids."""
    return F.flatten(F.transform(_col(lengths), lambda n, i: F.array_repeat(i + 1, n.cast("int"))))


def causal_starts(lengths: Column | str) -> Column:
    """For each token of a pack the first place that it sees: the start of its own sequence.  With the token's own place it says
    the same as the block-causal mask, in one number a token."""
    lens = F.transform(_col(lengths), lambda n: F.greatest(n.cast("int"), F.lit(0)))
    before = lambda i: F.aggregate(F.slice(lens, F.lit(1), i), F.lit(0), lambda acc, x: acc + x)
    return F.flatten(F.transform(lens, lambda n, i: F.array_repeat(before(i), n)))


def block_causal_mask(segment_ids: Column | str) -> Column:
    """array<array<boolean>>: token i sees token j if j <= i and both bear the same segment id, 0 (padding) apart."""
    ids = _col(segment_ids)
    return F.transform(ids, lambda x, i: F.transform(ids, lambda y, j: (x == y) & (x != 0) & (j <= i)))


def additive_mask(mask: Column | str, low: float = float("-inf")) -> Column:
    """0 where a mask is true, ``low`` elsewhere."""
    return F.transform(_col(mask), lambda row: F.transform(row, lambda x: F.when(x, F.lit(0.0)).otherwise(F.lit(low))))


def lengths_fill(lengths: Column | str, n: Column | int) -> Column:
    """Whether the lengths are none below 0 and sum to n."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.forall(_col(lengths), lambda x: x >= 0) & (F.aggregate(_col(lengths), F.lit(0).cast("long"), lambda acc, x: acc + x) == n)


def equal_lengths(*arrays: Column | str) -> Column:
    """Whether all arrays have the same number of elements (a null array has none of its own)."""
    sizes = [F.coalesce(F.size(_col(a)), F.lit(-1)) for a in arrays]
    return F.array_min(F.array(*sizes)) == F.array_max(F.array(*sizes))


def consistent_prefix(prefix: Column | str, full: Column | str, trailing: int | None = None) -> Column:
    """Whether ``full`` begins with ``prefix``; with ``trailing``, a prefix of two tokens or more may end with that token instead."""
    p, f = _col(prefix), _col(full)
    n = F.size(p)
    same = F.slice(f, F.lit(1), n) == p
    if trailing is not None:
        but_last = F.greatest(n - 1, F.lit(0))
        same = same | ((n > 1) & (F.try_element_at(p, F.lit(-1)) == trailing) & (F.slice(f, F.lit(1), but_last) == F.slice(p, F.lit(1), but_last)))
    return (n <= F.size(f)) & same


def _common_head(a: Column, b: Column, most: Column) -> Column:
    """How many of the first ``most`` elements agree before the first that does not."""
    differs = F.array_position(F.zip_with(F.slice(a, F.lit(1), most), F.slice(b, F.lit(1), most), lambda x, y: F.when(x == y, 0).otherwise(1)), 1)
    return F.when(differs > 0, differs - 1).otherwise(most).cast("int")


def reasoning_span(full: Column | str, masked: Column | str) -> Column:
    """struct<start, end>: the tokens of ``full`` between the longest common head and tail with ``masked``; null if there are none."""
    f, m = _col(full), _col(masked)
    head = _common_head(f, m, F.least(F.size(f), F.size(m)))
    tail = _common_head(F.reverse(f), F.reverse(m), F.least(F.size(f), F.size(m)) - head)
    end = F.size(f) - tail
    return F.when(end > head, F.struct(head.alias("start"), end.alias("end")))


def expand_placeholder(ids: Column | str, placeholder: int, n: Column | int) -> Column:
    """Each placeholder becomes n of them."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.flatten(F.transform(_col(ids), lambda x: F.when(x == placeholder, F.array_repeat(x, n.cast("int"))).otherwise(F.array(x))))


def marker_labels(ids: Column | str, marker: int, stop: int) -> Column:
    """Labels between an assistant marker (excluded) and the stop token (included); the rest is -100."""
    start = F.struct(F.lit(False).alias("on"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        label = F.when(acc["on"], x).otherwise(F.lit(IGNORE))
        on = F.when(x == marker, True).when(x == stop, False).otherwise(acc["on"])
        return F.struct(on.alias("on"), F.concat(acc["out"], F.array(label.cast("int"))).alias("out"))

    return F.aggregate(_col(ids), start, step, lambda acc: acc["out"])


def top_k_probabilities(p: Column | str, k: int) -> Column:
    """The k largest probabilities renormalised: array<struct<id, p>>."""
    best = F.slice(F.sort_array(F.transform(_col(p), lambda x, i: F.struct(x.alias("p"), (-i).alias("minus_id"))), asc=False), 1, k)
    total = F.aggregate(best, F.lit(0.0), lambda acc, x: acc + x["p"])
    return F.transform(best, lambda x: F.struct((-x["minus_id"]).alias("id"), (x["p"] / total).alias("p")))


def loss_weight(n: Column | str, kind: str) -> Column:
    """token: 1; sample: 1 / n; square: 1 / sqrt(n)."""
    return {"token": F.lit(1.0), "sample": 1 / _col(n), "square": 1 / F.sqrt(_col(n))}[kind]
