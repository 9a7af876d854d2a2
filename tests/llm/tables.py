"""Words and schemas of the test tables."""

WORDS = "harbor lantern quiet orchard winter copper letter bridge morning shadow garden river engine violet window story table answer kettle marble saddle thunder pepper feather".split()
CHUNKS = "id string, text string, n_tokens int, book_id string, split string"
PARAGRAPHS = "book_id string, chapter_index int, scene_index int, paragraph_index int, text string, n_tokens int, n_tokens_with_sep int"
SCENES = "book_id string, chapter_index int, scene_index int, headings array<string>, paragraphs array<struct<paragraph_index:int,n_tokens:int>>, n_paragraphs int, n_tokens int"
BUDGETS = "task string, item_level string, capacity int, overlap int, sep_tokens int"
