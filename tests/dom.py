"""A small document tree for expected values, apart from the engine's rules."""

from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


class Node:
    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def strings(self):
        for child in self.children:
            if not isinstance(child, Node):
                yield child
            elif child.tag not in ("script", "style"):
                yield from child.strings()

    def text(self, sep=""):
        return sep.join(s.strip() for s in self.strings() if s.strip())

    def raw(self):
        return "".join(self.strings())

    def ancestors(self):
        node = self.parent
        while node is not None:
            yield node
            node = node.parent


class Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.open)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node

    def handle_startendtag(self, tag, attrs):
        self.open.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.open))

    def handle_endtag(self, tag):
        node = self.open
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.open = node.parent

    def handle_data(self, data):
        self.open.children.append(data)


def tree(page):
    builder = Builder()
    builder.feed(page)
    builder.close()
    return builder.root


def select(root, tag=None, classes=(), **attrs):
    return [
        n for n in root.walk()
        if (tag is None or n.tag == tag)
        and all(c in n.attrs.get("class", "").split() for c in classes)
        and all(part in n.attrs.get(a, "") for a, part in attrs.items())
    ]
