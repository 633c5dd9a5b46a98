"""Densities, threshold and maximum sums against a plain recursive computation on random trees; time of odd pages."""

import math
import random
import time

import pytest

from epiloom.llm.html_text import extract, main_text

INLINE, GROUPS = ("b", "i", "a"), ("div", "section")


class Node:
    def __init__(self, tag, parts):
        self.tag, self.parts = tag, parts  # strings and nodes in order

    def html(self):
        return f"<{self.tag}>" + "".join(p if isinstance(p, str) else p.html() for p in self.parts) + f"</{self.tag}>"

    def kids(self):
        return [p for p in self.parts if isinstance(p, Node)]

    def every(self):
        return [self, *[n for k in self.kids() for n in k.every()]]

    def chars(self, linked=None, inside=False):
        """Characters without spaces; with linked only those inside a link."""
        inside = inside or self.tag == "a"
        own = sum(len(p.replace(" ", "")) for p in self.parts if isinstance(p, str)) if inside or not linked else 0
        return own + sum(k.chars(linked, inside) for k in self.kids())


def random_tree(rng, depth=0):
    if depth == 4 or depth > 1 and rng.random() < 0.3:
        words = [rng.choice(["alpha", "be", "gamma", "delta", "e"]) for _ in range(rng.randint(1, 25))]
        parts = [" ".join(words)]
        if rng.random() < 0.5:
            parts.append(Node(rng.choice(INLINE), ["linked or bold"]))
        return Node("p", parts)
    return Node("body" if depth == 0 else rng.choice(GROUPS), [random_tree(rng, depth + 1) for _ in range(rng.randint(1, 4))])


def expected(body):
    """Lines of the subtrees that the method chooses."""
    root = Node("#root", [body])
    nodes = root.every()
    parent = {id(k): n for n in nodes for k in n.kids()}

    def links_around(node):
        while node is not None:
            if node.tag == "a":
                return True
            node = parent.get(id(node))
        return False

    page, page_links = max(root.chars(), 1), root.chars(linked=True)

    def density(n):
        c = n.chars()
        if not c:
            return 0.0
        lc = c if links_around(n) else n.chars(linked=True)
        t = max(len(n.every()) - 1, 1)
        lt = sum(m.tag == "a" for m in n.every()[1:])
        base = math.log(c / max(c - lc, 1) * lc + page_links / page * c + math.e)
        ratio = c / max(lc, 1) * t / max(lt, 1)
        return max(c / t * math.log(max(ratio, 1.0000001)) / math.log(base) if base > 1.0000001 else c / t, 0.0)

    dense = {id(n): density(n) for n in nodes}

    def total(n):
        below = 0.0
        for k in n.kids():
            below += dense[id(k)]
        return below or dense[id(n)]

    def largest(among):
        return max(among, key=total)  # the first of equal ones

    best = largest(nodes)
    path = [best]
    while id(path[-1]) in parent:
        path.append(parent[id(path[-1])])
    threshold = min(dense[id(n)] for n in path)
    picked = [best]

    def look(n):
        if any(n is p for p in path):
            for k in n.kids() if n is not best else []:
                look(k)
        elif dense[id(n)] >= threshold:
            picked.append(largest(n.every()))
        else:
            for k in n.kids():
                look(k)

    look(root)
    inside = {id(m) for n in picked for m in n.every()}
    lines, own, group = [], [], None

    def end():
        text = " ".join("".join(own).split())
        own.clear()
        if text:
            lines.append(text)

    top = {}
    for n in picked:
        for m in n.every():
            top.setdefault(id(m), id(n))

    def walk(n):
        nonlocal group
        block = n.tag not in INLINE
        if block:
            end()
        for p in n.parts:
            if isinstance(p, str):
                if top.get(id(n)) != group:
                    end()
                group = top.get(id(n))
                if id(n) in inside:
                    own.append(p)
            else:
                walk(p)
        if block:
            end()

    walk(root)
    return lines


@pytest.mark.parametrize("seed", range(150))
def test_chosen_subtrees(seed):
    body = random_tree(random.Random(seed))
    assert main_text(body.html()).split("\n") == expected(body)


ODD = {
    "unclosed": "a<" * 500_000,
    "unclosed with names": "<a b" * 250_000,
    "quotes": '<a "' * 250_001,
    "both quotes": "<a '\"" * 200_001,
    "stray ends": "<b>" * 20_000 + "</i>" * 200_000,
    "lists in spans": "<span>" * 20_000 + "<li>" * 20_000,
    "scripts": "<script></script " * 60_000,
    "declarations": "<!" * 500_000,
}


@pytest.mark.parametrize("name", ODD)
def test_time_follows_the_length(name):
    start = time.process_time()
    main_text(ODD[name])
    assert time.process_time() - start < 4


def test_places_without_an_end_are_text():
    assert main_text("<p>one <b two</p>") == "one"  # the name of the tag ends at the space, its end is that of </p>
    assert main_text("<p>x</p>1 < 2 <a 'b") == "x\n1 < 2 <a 'b"
    assert main_text("<p title='a > b'>in</p>") == "in" and main_text("<p title='a > in") == "in"
    assert main_text("<title>a</title <p>b</p>c") == "bc"  # the end tag of the title ends with the first >


def test_numbers_of_any_length():
    assert main_text("<p>a&#" + "0" * 5000 + "65;b</p>") == "aAb"
    assert main_text("<p>a&#" + "9" * 5000 + ";b</p>") == "a�b"


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, html string, n_chars int")
    got = extract(pages, keep=["page_id"])
    assert got.columns == ["page_id", "text", "n_chars"] and got.count() == 0
