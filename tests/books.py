"""Ten documents with every kind of field."""

import datetime as dt

from corvane.plans import schema as s

YEARS = {"mockingbird": 1960, "1984": 1949, "pride": 1813, "gatsby": 1925, "catcher": 1951, "moby": 1851, "hobbit": 1937, "harry": 1997, "lotr": 1954, "alchemist": 1988}
DATES = {"mockingbird": "1960-07-11", "1984": "1949-06-08", "pride": "1813-01-28", "gatsby": "1925-04-10", "catcher": "1951-07-16", "moby": "1851-10-18", "hobbit": "1937-09-21", "harry": "1997-06-26", "lotr": "1954-07-29", "alchemist": "1988-01-01"}
TITLES = {
    "mockingbird": "To Kill a Mockingbird", "1984": "1984", "pride": "Pride and Prejudice", "gatsby": "The Great Gatsby", "catcher": "The Catcher in the Rye",
    "moby": "Moby-Dick", "hobbit": "The Hobbit", "harry": "Harry Potter and the Sorcerer's Stone", "lotr": "The Lord of the Rings", "alchemist": "The Alchemist",
}
SUMMARIES = {
    "mockingbird": "A lawyer in a small town defends a man, and two children learn about justice.",
    "1984": "A clerk under a regime that watches everyone begins a secret love.",
    "pride": "A witty woman and a proud gentleman fall in love after many mistakes.",
    "gatsby": "A rich man gives parties for a love that he lost, and love does not come back.",
    "catcher": "A young man leaves school and walks through the city.",
    "moby": "A captain hunts a white whale across the sea.",
    "hobbit": "A quiet hobbit goes on a quest with dwarves and meets a dragon.",
    "harry": "A young wizard enters a school of magic.",
    "lotr": "A hobbit carries a ring on a long quest to destroy it.",
    "alchemist": "A shepherd follows his dream of treasure.",
}
RATINGS = {"pride": 4, "gatsby": 3, "moby": 5, "hobbit": 3}
USER_RATINGS = {"mockingbird": [9, 7, 10, 8], "1984": [5.0, 3.5, 4.5, 4.0, -1.0], "pride": ["romantic", "classic", "good"], "gatsby": "good book", "catcher": [4.5, 3.0, 3.5, 4.0, -1.0], "moby": [-5, 2, -1, 1], "hobbit": [5, 3, 4, 5, 2], "harry": 10, "lotr": ["epic", "legendary", "good"], "alchemist": [8, 10, 9, 7]}
TAGS = {"mockingbird": ["racism", "justice"], "1984": ["dystopia", "love"], "pride": ["love", "class"], "gatsby": ["love", "wealth"], "catcher": ["youth"], "moby": ["obsession", "whale"], "hobbit": ["adventure", "magic"], "harry": ["magic", "friendship"], "lotr": ["adventure", "magic"], "alchemist": ["destiny", "dream"]}
IMPORTANCE = {"mockingbird": 2.0, "moby": 5.0}

SCHEMA = {
    "title": s.text().required().indexed(s.keyword_index()),
    "published_year": s.integer().required(),
    "published_ts": s.timestamp(),
    "summary": s.text().indexed(s.keyword_index()),
    "blurb": s.text().indexed(s.semantic_index()),
    "genre": s.text().indexed(s.keyword_index(exact=True)),
    "summary_embedding": s.vector(16).indexed(s.vector_index("euclidean")),
    "nullable_embedding": s.vector(4).indexed(s.vector_index("cosine")),
    "binary_embedding": s.vector(2, "binary").indexed(s.vector_index("hamming")),
    "sparse_embedding": s.sparse_vector().indexed(s.vector_index("dot_product")),
    "token_embeddings": s.matrix(2).indexed(s.multi_vector_index()),
    "tags": s.list_("text").indexed(s.keyword_index()),
}
GENRES = {"hobbit": "High Fantasy", "lotr": "High Fantasy", "harry": "Fantasy", "pride": "Romance"}


def documents() -> list[dict]:
    out = []
    for i, (key, year) in enumerate(YEARS.items(), 1):
        d = {
            "_id": key, "title": TITLES[key], "published_year": year, "published_ts": dt.datetime.fromisoformat(DATES[key]).replace(tzinfo=dt.UTC), "summary": SUMMARIES[key], "blurb": SUMMARIES[key],
            "summary_embedding": [float(i)] * 16, "tags": TAGS[key], "user_ratings": USER_RATINGS[key], "sparse_embedding": {i: 1.0, 100: 0.5 * i}, "meta": {"century": year // 100 + 1, "name": {"short": key[:3]}},
        }
        if key in RATINGS:
            d["rating"] = RATINGS[key]
        if key in IMPORTANCE:
            d["importance"] = IMPORTANCE[key]
        if key in GENRES:
            d["genre"] = GENRES[key]
        if i % 3 == 0:
            d["nullable_embedding"] = [float(i), 1.0, 0.0, 0.0]
            d["token_embeddings"] = [[1.0, float(i)], [float(-i), 1.0]]
        if i <= 4:
            d["binary_embedding"] = [i, 255]
        out.append(d)
    return out
