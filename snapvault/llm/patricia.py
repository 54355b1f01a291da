"""Patricia tries over byte strings, with owners at their ends and subtrees that can be taken out."""

from __future__ import annotations


def common_prefix(a: bytes, i: int, b: bytes, j: int) -> int:
    """Length of the common prefix of ``a[i:]`` and ``b[j:]``, by doubling and halving slices."""
    most = min(len(a) - i, len(b) - j)
    n, step = 0, 32
    while n < most:
        step = min(step, most - n)
        if a[i + n:i + n + step] == b[j + n:j + n + step]:
            n += step
            step *= 2
        elif step == 1:
            break
        else:
            step //= 2
    return n


class Node:
    """``label``: bytes on the edge into the node; ``owner``: what the end of a string holds."""

    __slots__ = ("children", "gone", "label", "owner")

    def __init__(self, label: bytes, owner=None):
        self.label, self.owner, self.children, self.gone = label, owner, {}, False


class Patricia:
    """A compressed radix trie: byte string -> owner.

    An owner is a tuple ``(smallest id, largest id, rows, key)``; inserting a
    string again merges owners.  ``evict`` cuts the heaviest subtree out and
    leaves a stub: later strings that reach the stub are handed back by
    ``insert`` so that the caller can send them after the others.
    """

    def __init__(self):
        self.root, self.bytes, self.strings = Node(b""), 0, 0

    def insert(self, key: bytes, owner: tuple, merge) -> bool:
        """False when the string belongs to a subtree that was cut out."""
        node, at = self.root, 0
        while True:
            if node.gone:
                return False
            if at == len(key):
                if node.owner is None:
                    self.strings += 1
                    node.owner = owner
                else:
                    node.owner = merge(node.owner, owner)
                return True
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], owner)
                self.bytes += len(key) - at + 200
                self.strings += 1
                return True
            n = len(child.label)
            if not key.startswith(child.label, at):
                n = common_prefix(child.label, 0, key, at)
                upper = Node(child.label[:n])
                child.label = child.label[n:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = child = upper
                self.bytes += 200
            node, at = child, at + n

    def items(self, node: Node | None = None, prefix: bytes = b""):
        """(string, owner) of every end below ``node``."""
        stack = [(node or self.root, prefix)]
        while stack:
            x, before = stack.pop()
            here = before + x.label
            if x.owner is not None:
                yield here, x.owner
            stack.extend((c, here) for c in x.children.values())

    def evict(self):
        """Cut out the heaviest child of the first branching node: its (string, owner) pairs, or none."""
        node, prefix = self.root, b""
        while len(node.children) == 1 and node.owner is None:
            only = next(iter(node.children.values()))
            if only.gone or not only.children:
                return []
            node, prefix = only, prefix + only.label
        live = [c for c in node.children.values() if not c.gone]
        if not live or (len(live) == 1 and node.owner is None and len(node.children) == 1):
            return []
        weights = {id(c): sum(len(x.label) + 200 for x in self._below(c)) for c in live}
        heaviest = max(live, key=lambda c: weights[id(c)])
        out = list(self.items(heaviest, prefix))
        heaviest.children, heaviest.owner, heaviest.gone = {}, None, True
        self.bytes -= weights[id(heaviest)]
        self.strings -= len(out)
        return out

    @staticmethod
    def _below(node: Node):
        stack = [node]
        while stack:
            x = stack.pop()
            yield x
            stack.extend(x.children.values())
