"""DuckDB statements that compute the registered queries directly.

The TF-IDF statement fits one model per report on its candidates plus the report, so it is
independent of the shared statistics and of the pruning in the library.
"""

from __future__ import annotations

from caseweave.functions.text import english_stop_words
from caseweave.operators.prompts import (
    BASELINE_INSTRUCTION,
    EVIDENCE_HEADING,
    FALLBACK_TEMPLATES,
    NO_RESPONSE,
    RAG_INSTRUCTION,
)
from caseweave.operators.shaping import LOW_NOTICE, MEDIUM_NOTICE, NO_EVIDENCE, NO_FIX_STEP

SPACE = r"[\t-\r\x1c-\x1f \x{85}\p{Z}]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
HEADING = rf"^{SPACE}*(?:#+{SPACE}*)?\p{{Nd}}+\.{SPACE}+(.+?){SPACE}*$"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strip(value: str) -> str:
    return f"regexp_replace({value}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def tokens(value: str) -> str:
    return f"list_filter(string_split_regex({value}, '{SPACE}+'), lambda t: t <> '')"


def joined(items: str, separator: str) -> str:
    return f"coalesce(array_to_string({items}, {separator}), '')"


def three(value: str) -> str:
    return f"cast(printf('%.3f', {value}) as double)"


def label(score: str) -> str:
    return f"case when {score} >= 0.45 then 'high' when {score} >= 0.2 then 'medium' else 'low' end"


def share(value: str, focus: str) -> str:
    hits = f"len(list_filter({focus}, lambda w: contains(lower({value}), lower(w))))"
    return f"{hits} / cast(greatest(len({focus}), 1) as double)"


NL = "chr(10)"

KB = f"""
kb as (
  select doc_id as kb_id, string_split(text, {NL})[1] as error, lang as platform,
    source as context, [lang, source] as tags, '' as explanation, 'see ' || source as solution, text as root_cause,
    string_split(text, {NL})[2:] as fix_steps, cast([] as varchar[]) as common_mistakes,
    source as source_type, 'doc://' || doc_id as source_url
  from documents),
kb_documents as (
  select kb_id, concat_ws({NL}, 'Error: ' || error, 'Platform: ' || platform,
    'Context: ' || context, 'Explanation: ' || explanation, 'Root cause: ' || root_cause,
    'Fix steps: ' || {joined('fix_steps', "' '")}, 'Common mistakes: ',
    'Tags: ' || {joined('tags', "' '")}) as document
  from kb)"""

REPORTS = f"""
raw_reports as (
  select item_id as report_id, ' ' || text || {NL} as error_message,
    [' EN' || chr(9), 'fr', null, 'Src1', 'zz'][item_id % 5 + 1] as environment,
    case when item_id % 3 <> 0 then 'lot ' || (item_id % 3) else '  ' end as assignment_context,
    case when item_id % 4 = 1 then 'run(' || item_id || ')' end as code_snippet,
    METHOD as retrieval_method
  from benchmark),
reports as (
  select report_id, {strip("coalesce(error_message, '')")} as error_message,
    {strip("coalesce(environment, '')")} as environment,
    {strip("coalesce(assignment_context, '')")} as assignment_context,
    {strip("coalesce(code_snippet, '')")} as code_snippet, retrieval_method
  from raw_reports),
report_texts as (
  select report_id, concat_ws({NL},
    case when error_message <> '' then 'Error message: ' || error_message end,
    case when environment <> '' then 'Environment: ' || environment end,
    case when assignment_context <> '' then 'Assignment context: ' || assignment_context end,
    case when code_snippet <> '' then 'Code snippet: ' || code_snippet end) as report_text
  from reports)"""

PLAIN_REPORTS = REPORTS.replace("METHOD", "'tfidf'")
MIXED_REPORTS = REPORTS.replace(
    "METHOD", "['tfidf', 'Embeddings', 'something else'][item_id % 3 + 1]"
)

CANDIDATES = f"""
matched as (
  select r.report_id, k.kb_id from reports r join kb k
  on r.environment <> '' and (contains(lower(k.platform), lower(r.environment))
    or contains(lower(k.context), lower(r.environment))
    or contains(lower({joined('k.tags', "' '")}), lower(r.environment)))),
candidates as (
  select report_id, kb_id from matched
  union all
  select r.report_id, k.kb_id from reports r cross join kb k
  where r.report_id not in (select report_id from matched))"""


def words(source: str, key: str, column: str) -> str:
    stop = ", ".join(text(word) for word in english_stop_words())
    return f"""
  select {key}, term, cast(count(*) as integer) as tf from (
    select {key}, unnest(regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{N}}_]{{2,}}')) as term
    from {source})
  where term not in ({stop}) group by all"""


TFIDF = f"""
kb_words as ({words('kb_documents', 'kb_id', 'document')}),
report_words as ({words('report_texts', 'report_id', 'report_text')}),
fitted as (
  select c.report_id, c.kb_id, w.term, w.tf from candidates c join kb_words w using (kb_id)
  union all
  select report_id, -1, term, tf from report_words),
sizes as (select report_id, count(*) + 1 as n from candidates group by report_id),
frequencies as (select report_id, term, count(*) as df from fitted group by all),
weights as (
  select f.report_id, f.kb_id, f.term, f.tf, d.df, s.n,
    ln((1.0 + s.n) / (1.0 + d.df)) + 1 as idf,
    f.tf * (ln((1.0 + s.n) / (1.0 + d.df)) + 1) as weight
  from fitted f join frequencies d using (report_id, term) join sizes s using (report_id)),
lengths as (select report_id, kb_id, sqrt(sum(weight * weight)) as length from weights group by all),
dots as (
  select q.report_id, d.kb_id, sum(q.weight * d.weight) as dot
  from weights q join weights d using (report_id, term)
  where q.kb_id = -1 and d.kb_id <> -1 group by all),
tfidf_scores as (
  select c.report_id, c.kb_id, coalesce(round(dot / (lq.length * ld.length), 9), 0.0) as score
  from candidates c left join dots using (report_id, kb_id)
  left join lengths lq on lq.report_id = c.report_id and lq.kb_id = -1
  left join lengths ld on ld.report_id = c.report_id and ld.kb_id = c.kb_id)"""


def top(scores: str, k: int = 3) -> str:
    return f"""
  select report_id, cast(rank as integer) as rank, kb_id, score from (
    select *, row_number() over (partition by report_id order by score desc, kb_id) as rank
    from ({scores}))
  where rank <= {k}"""


def cosine(asks: str, cases: str) -> str:
    """Scores of (report_id, a) against (kb_id, b) pairs given by a join condition."""
    return f"""
  select report_id, kb_id, round(list_dot_product(a, b)
    / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))), 9) as score
  from {asks} join {cases}"""


OVERLAP = f"""
kb_tokens as (
  select kb_id, list_distinct({tokens('lower(document)')}) as tokens from kb_documents),
report_tokens as (
  select report_id, list_distinct({tokens('lower(report_text)')}) as tokens from report_texts),
overlap_scores as (
  select c.report_id, c.kb_id,
    round(len(list_intersect(r.tokens, k.tokens)) / cast(greatest(len(r.tokens), 1) as double), 9)
      as score
  from candidates c join report_tokens r using (report_id) join kb_tokens k using (kb_id))"""

MIXED_SCORES = f"""
report_vectors as (
  select report_id, cast(embedding as double[]) as a from reports
  join embeddings on vec_id = (report_id * 7 + 3) % (select count(*) from embeddings)),
kb_vectors as (
  select kb_id, cast(embedding as double[]) as b from kb
  join embeddings on vec_id = kb_id % (select count(*) from embeddings)),
vector_scores as ({cosine('candidates join report_vectors using (report_id)', 'kb_vectors using (kb_id)')}),
mixed_scores as (
  select s.* from tfidf_scores s join reports using (report_id)
  where lower(retrieval_method) <> 'embeddings'
  union all
  select s.* from vector_scores s join reports using (report_id)
  where lower(retrieval_method) = 'embeddings')"""

PLAIN = ",".join([KB, PLAIN_REPORTS, CANDIDATES, TFIDF])
RETRIEVED = f"{PLAIN}, retrieved as ({top('select * from tfidf_scores')})"
MIXED = ",".join([KB, MIXED_REPORTS, CANDIDATES, TFIDF, MIXED_SCORES])
MIXED_RETRIEVED = f"{MIXED}, retrieved as ({top('select * from mixed_scores')})"

LABELS = f"""
labels_of as (
  select r.report_id, {label('t.score')} as retrieval_confidence
  from reports r left join (select * from retrieved where rank = 1) t using (report_id))"""

EVIDENCE = f"""
examples as (
  select report_id, rank, score, concat_ws({NL}, 'Example ' || rank,
    'Score: ' || printf('%.3f', score), 'Error: ' || error, 'Platform: ' || platform,
    'Quoted root cause: "' || root_cause || '"', 'Explanation: ' || explanation,
    'Quoted fix steps: ' || {joined("list_transform(fix_steps, lambda s: '\"' || s || '\"')", "' | '")},
    'Common mistakes: ' || {joined('common_mistakes', "' | '")},
    'Source: ' || source_type || ' - ' || source_url) as example
  from retrieved join kb using (kb_id)),
evidence_of as (
  select r.report_id, coalesce('Retrieval confidence: ' || {label('max(score)')} || {NL} || {NL}
    || string_agg(example, {NL} || {NL} order by rank), {text(NO_EVIDENCE)}) as evidence
  from reports r left join examples using (report_id) group by r.report_id)"""

INPUTS = f"""
inputs as (
  select report_id,
    'Error message: ' || coalesce(nullif(error_message, ''), 'Not provided') as error_line,
    'Environment: ' || coalesce(nullif(environment, ''), 'Not provided') as environment_line,
    'Assignment context: ' || coalesce(nullif(assignment_context, ''), 'Not provided') as context_line,
    'Code snippet:' || {NL} || coalesce(nullif(code_snippet, ''), 'Not provided') as code_line
  from reports),
prompt_inputs as (
  select report_id,
    concat_ws({NL}, error_line, environment_line, context_line, code_line) as rag_input,
    concat_ws({NL}, error_line, code_line) as baseline_input
  from inputs)"""

def responses(key: str) -> str:
    return f"""
responses as (
  select {key} as report_id, case when (turn // 2) % 2 = 0 then 'rag' else 'baseline' end as mode,
    string_agg(text, {NL} order by conv_id, turn, text) as text
  from conversations where role = 'assistant' group by all)"""


def answers(key: str) -> str:
    return f"""{responses(key)},
answers as (
  select r.report_id, coalesce(a.text, {text(NO_RESPONSE)}) as rag_response,
    coalesce(b.text, {text(NO_RESPONSE)}) as baseline_response
  from reports r left join responses a on a.report_id = r.report_id and a.mode = 'rag'
  left join responses b on b.report_id = r.report_id and b.mode = 'baseline')"""


ANSWERS = answers("conv_id % (select count(*) from benchmark)")

EXAMPLES = f"""
listed as (
  select report_id,
    string_agg(concat_ws('|', rank, kb_id, printf('%.3f', score), error, platform, context,
      {joined('tags', "','")}, explanation, root_cause, {joined('fix_steps', "';'")},
      {joined('common_mistakes', "';'")}, solution, source_type, source_url),
      {NL} || {NL} order by rank) as retrieved_examples,
    string_agg(concat_ws('|', error, platform, printf('%.3f', score), root_cause,
      {joined('fix_steps', "';'")}, source_url), {NL} || {NL} order by rank) as top_retrievals,
    count(*) as evidence_count, max(score) as top_score
  from retrieved join kb using (kb_id) group by report_id)"""

HITS = f"""
focus as (
  select report_id, {tokens("' ' || text || chr(10)")} as expected_focus
  from (select item_id as report_id, text from benchmark)),
retrieved_texts as (
  select report_id, string_agg(concat_ws(' ', error, root_cause, {joined('fix_steps', "' '")}),
    ' ' order by rank) as retrieved_text
  from retrieved join kb using (kb_id) group by report_id),
hits as (
  select report_id, {share("coalesce(retrieved_text, '')", 'expected_focus')} as retrieval_score
  from focus left join retrieved_texts using (report_id))"""

CASE_RESULTS = f"""
case_results as (
  select 'case' || report_id as id, w.error_message, coalesce(w.environment, '') as environment,
    w.retrieval_method, retrieval_confidence, retrieval_score,
    {joined('expected_focus', "'|'")} as expected_focus,
    coalesce(top_retrievals, '') as top_retrievals,
    {share('rag_response', 'expected_focus')} as rag_score,
    {share('baseline_response', 'expected_focus')} as baseline_score,
    {share('rag_response', 'expected_focus')} - {share('baseline_response', 'expected_focus')}
      as score_delta, rag_response, baseline_response
  from raw_reports w join focus using (report_id) join labels_of using (report_id)
  join hits using (report_id) join answers using (report_id)
  left join listed using (report_id))"""


def with_(parts: str, select: str) -> str:
    return f"with {parts} {select}"


def statements() -> dict[str, str]:
    rag_prompt = (
        f"rag_input || {NL} || {NL} || {text(EVIDENCE_HEADING)} || {NL} || evidence"
        f" || {NL} || {NL} || {text(RAG_INSTRUCTION)}"
    )
    baseline_prompt = f"baseline_input || {NL} || {NL} || {text(BASELINE_INSTRUCTION)}"
    kb_columns = f"""kb_id, error, platform, context, {joined('tags', "'|'")} as tags, explanation,
      root_cause, {joined('fix_steps', "'|'")} as fix_steps,
      {joined('common_mistakes', "'|'")} as common_mistakes, solution, source_type, source_url"""
    summary = with_(
        f"{RETRIEVED}, {LABELS}, {HITS}, {ANSWERS}, {EXAMPLES}, {CASE_RESULTS}",
        f"""select count(*) as num_cases, {three('avg(retrieval_score)')} as average_retrieval_score,
        {three('avg(rag_score)')} as average_rag_score,
        {three('avg(baseline_score)')} as average_baseline_score,
        {three('avg(score_delta)')} as average_score_delta,
        count(*) filter (score_delta > 0) as rag_better_cases,
        count(*) filter (score_delta = 0) as tied_cases,
        count(*) filter (score_delta < 0) as baseline_better_cases
        from case_results""",
    )
    return {
        "kb_scan": with_(KB, f"select {kb_columns} from kb"),
        "cases_scan": with_(
            PLAIN_REPORTS,
            f"""select report_id, 'case' || report_id as id, error_message,
            coalesce(environment, '') as environment, assignment_context,
            coalesce(code_snippet, '') as code_snippet,
            {joined(tokens('error_message'), "'|'")} as expected_focus, retrieval_method
            from raw_reports""",
        ),
        "normalize_input": with_(
            PLAIN_REPORTS,
            """select report_id, error_message, code_snippet, environment, assignment_context
            from reports""",
        ),
        "valid_reports": f"""select conv_id as response_id, turn, {strip('text')} as error_message
            from conversations where {strip('text')} <> ''""",
        "report_text": with_(PLAIN_REPORTS, "select * from report_texts"),
        "kb_document": with_(KB, "select kb_id, document from kb_documents"),
        "candidate_filter": with_(
            ",".join([KB, PLAIN_REPORTS, CANDIDATES]),
            """select distinct case when report_id in (select report_id from matched)
            then lower(environment) else '' end as candidate_group, kb_id
            from candidates join reports using (report_id)""",
        ),
        "terms": with_(KB, f"select * from ({words('kb_documents', 'kb_id', 'document')})"),
        "term_stats": with_(
            PLAIN,
            """select w.report_id, w.term, w.tf, w.df, w.n as documents, round(w.idf, 9) as idf,
            round(w.weight / l.length, 9) as weight
            from weights w join lengths l using (report_id, kb_id) where w.kb_id = -1""",
        ),
        "tfidf_topk": with_(PLAIN, top("select * from tfidf_scores")),
        "tfidf_top5": with_(PLAIN, top("select * from tfidf_scores", 5)),
        "overlap_topk": with_(
            ",".join([KB, PLAIN_REPORTS, CANDIDATES, OVERLAP]), top("select * from overlap_scores")
        ),
        "embedding_topk": "with v as (select vec_id, label, cast(embedding as double[]) as e"
        " from embeddings)"
        + top(
            cosine(
                "(select vec_id as report_id, label as la, e as a from v)",
                """(select vec_id as kb_id, label as lb, e as b from v)
                on report_id % 3 <> 0 or contains('label' || lb, 'label' || la)""",
            )
        ),
        "retrieve": with_(MIXED, top("select * from mixed_scores")),
        "confidence": with_(f"{RETRIEVED}, {LABELS}", "select * from labels_of"),
        "run_metrics": with_(
            f"{RETRIEVED}, {LABELS}",
            f"""select r.report_id, r.retrieval_method, l.retrieval_confidence,
            count(t.kb_id) as evidence_count, coalesce(max(t.score), 0.0) as top_score,
            case l.retrieval_confidence when 'low' then {text(LOW_NOTICE)}
              when 'medium' then {text(MEDIUM_NOTICE)} end as notice
            from reports r join labels_of l using (report_id) left join retrieved t using (report_id)
            group by all""",
        ),
        "evidence_context": with_(f"{RETRIEVED}, {EVIDENCE}", "select * from evidence_of"),
        "primary_evidence": with_(
            RETRIEVED,
            f"""select report_id, error, {three('score')} as score,
            {label('score')} as retrieval_confidence, root_cause,
            coalesce(fix_steps[1], {text(NO_FIX_STEP)}) as fix_step, source_url
            from retrieved join kb using (kb_id) where rank = 1""",
        ),
        "top_retrievals": with_(
            RETRIEVED,
            f"""select report_id, rank, kb_id, error, platform, platform as shown_platform,
            {three('score')} as score, explanation, root_cause,
            {joined('fix_steps', NL)} as fix_steps, source_type, source_url
            from retrieved join kb using (kb_id)""",
        ),
        "prompt_inputs": with_(f"{PLAIN_REPORTS}, {INPUTS}", "select * from prompt_inputs"),
        "prompt_requests": with_(
            f"{RETRIEVED}, {EVIDENCE}, {INPUTS}",
            f"""select report_id, 'rag' as mode, {text(FALLBACK_TEMPLATES['rag'])} as system_prompt,
            {rag_prompt} as user_prompt from prompt_inputs join evidence_of using (report_id)
            union all
            select report_id, 'baseline', {text(FALLBACK_TEMPLATES['baseline'])}, {baseline_prompt}
            from prompt_inputs""",
        ),
        "response_join": with_(
            f"reports as (select distinct conv_id as report_id from conversations), {answers('conv_id')}",
            "select * from answers",
        ),
        "debug_run": with_(
            f"{MIXED_RETRIEVED}, {LABELS}, {EVIDENCE}, {ANSWERS}, {EXAMPLES}",
            f"""select report_id, error_message, code_snippet, environment, assignment_context,
            retrieval_method, retrieval_confidence, coalesce(evidence_count, 0) as evidence_count,
            coalesce(top_score, 0.0) as top_score,
            case retrieval_confidence when 'low' then {text(LOW_NOTICE)}
              when 'medium' then {text(MEDIUM_NOTICE)} end as notice,
            coalesce(retrieved_examples, '') as retrieved_examples,
            evidence, rag_response, baseline_response
            from reports join labels_of using (report_id) join evidence_of using (report_id)
            join answers using (report_id) left join listed using (report_id)""",
        ),
        "response_sections": f"""with whole as (
              select conv_id as response_id, string_agg(
                '## ' || (turn + 1) || '. ' || role || {NL} || text, {NL} order by turn, text) as text
              from conversations group by conv_id),
            split as (
              select response_id, string_split_regex(
                regexp_replace(text, '(?:{LINE_END})$', ''), '{LINE_END}') as l from whole),
            numbered as (
              select response_id, unnest(l) as line, generate_subscripts(l, 1) as n from split),
            flagged as (
              select *, regexp_matches(line, '{HEADING}') as is_heading from numbered),
            placed as (
              select *, sum(cast(is_heading as integer)) over (
                partition by response_id order by n) as part from flagged),
            parts as (
              select response_id, part,
                coalesce({strip(f"regexp_extract(max(line) filter (is_heading), '{HEADING}', 1)")},
                  'Response') as title,
                {strip(f"string_agg(line, {NL} order by n) filter (not is_heading)")} as body
              from placed group by response_id, part having count(*) filter (not is_heading) > 0)
            select response_id,
              cast(row_number() over (partition by response_id order by part) as integer)
                as section_no, title, body
            from parts where title <> '' or body <> ''""",
        "keyword_coverage": with_(
            f"""{responses('conv_id')},
            focus as (
              select conv_id as report_id,
                {tokens(f'string_agg(text, {NL} order by turn, text)')} as expected_focus
              from conversations where role = 'user' group by conv_id)""",
            f"""select report_id, mode, {share('text', 'expected_focus')} as coverage
            from responses join focus using (report_id)""",
        ),
        "retrieval_hit": with_(f"{RETRIEVED}, {HITS}", "select * from hits"),
        "evaluate_cases": with_(
            f"{RETRIEVED}, {LABELS}, {HITS}, {ANSWERS}, {EXAMPLES}, {CASE_RESULTS}",
            "select * from case_results",
        ),
        "eval_summary": summary,
        "eval_read_back": summary,
    }
