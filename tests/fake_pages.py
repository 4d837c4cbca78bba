"""Pages for the tests of the paged source."""

from logweave.sources.paged import RetryLater


def fetch(url: str):
    key, page = url.split("/")[-2:]
    if key == "down":
        raise RetryLater("always", 0.0)
    if key == "gone":
        raise ValueError("404")
    rows = [{"id": f"{key}-{k}"} for k in range(5)]
    return {"items": rows[(int(page) - 1) * 2 : int(page) * 2]}


def growing(url: str):
    """Pages of two of a listing as long as the number in a file."""
    path, page = url.rsplit("/", 1)
    key = path.rsplit("/", 1)[1]
    with open(path) as f:
        n = int(f.read())
    if n < 0:
        raise RetryLater("away", 0.0)
    return [{"id": f"{key}-{k}"} for k in range(n)][(int(page) - 1) * 2 : int(page) * 2]
