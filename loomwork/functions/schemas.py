"""Nested records: reasoning chains, review actions, evidence."""

STEP = "struct<step: int, type: string, content: string, evidence: string, confidence: string>"
STEPS = f"array<{STEP}>"
CHAIN = f"struct<steps: {STEPS}, react_rounds: int, self_consistency_selected: int>"
PARAMS = (
    "struct<evidence: string, new_confidence: string, revised_content: string, step_a: int, step_b: int, "
    "new_step: struct<type: string, content: string, evidence: string, confidence: string>, "
    "merged: struct<type: string, content: string, confidence: string>>"
)
ACTION = f"struct<action: string, target_step: int, priority: string, params: {PARAMS}, reason: string>"
ACTIONS = f"array<{ACTION}>"
UNIFIED = f"struct<priority_actions: {ACTIONS}, optional_improvements: {ACTIONS}, conflicts_resolved: array<string>>"
SECTION = "struct<title: string, text: string>"
ARTICLE = f"title string, content string, sections array<{SECTION}>, url string, page_id long"
PASSAGE = "id string, text string, article_title string, section_title string, passage_index int, url string"
EVIDENCE = "struct<content: string, source: string, relevance_score: double, metadata: map<string, string>>"
ENTITY_RAW = (
    "name string, type string, aliases array<string>, description string, passage_ids array<string>, source_article string"
)
RELATION = "source string, target string, relation string, confidence double, evidence_passage_ids array<string>"
QA = "Question string, Answer string, `Question Type` string, `Reasoning Traces` string"
SCORES = (
    "struct<faithfulness: double, structure: double, information_density: double, logical_completeness: double, "
    "traceability: double, step_order: double, overall: double, ppl: double>"
)
