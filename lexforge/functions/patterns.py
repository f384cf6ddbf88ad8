"""Fixed values of the legal-document domain: word lists, character classes and patterns.

These must be exactly as they are for results to agree with established outputs; everything that uses them is elsewhere.
"""

from __future__ import annotations

# --- fixed values: character classes -------------------------------------------------------------------------------
#: Lower-case letters and digits that mark running text before a heading word.
LOWER = "a-z0-9àảãáạăằẳẵắặâầẩẫấậèẻẽéẹêềểễếệìỉĩíịòỏõóọôồổỗốộơờởỡớợùủũúụưừửữứựỳỷỹýỵđ"
LOWER_LETTERS = LOWER.replace("0-9", "")
UPPER = "A-ZÀẢÃÁẠĂẰẲẴẮẶÂẦẨẪẤẬÈẺẼÉẸÊỀỂỄẾỆÌỈĨÍỊÒỎÕÓỌÔỒỔỖỐỘƠỜỞỠỚỢÙỦŨÚỤƯỪỬỮỨỰỲỶỸÝỴĐ"
#: The class after a clause number; its last range holds lower-case letters too.
CLAUSE_UPPER = "A-ZÀÁÂÃÈÉÊÌÍÒÓÔÕÙÚĂĐĨŨƠƯẠ-ỹ"

# --- fixed values: headings ----------------------------------------------------------------------------------------
ARTICLE_WORDS = ("Điều", "Ðiều", "ĐIỀU", "ÐIỀU", "Điền", "Ðiền")
ARTICLE_NUMBER = r"\d{1,3}[a-zA-Zđ]?"
CHAPTER = r"Chương\s+[IVXLCDM]+\b"
SECTION = r"Mục\s+\d+\s*[.:]"
STOP_MARKERS = ("Nơi nhận:", "TM. CHÍNH PHỦ", "TM. CHINH PHU", "KT. BỘ TRƯỞNG", "FILE ĐƯỢC ĐÍNH KÈM", "PHỤ LỤC I")
BODY_PHRASES = (
    r"(?:Nghị định|Luật|Thông tư|Quyết định)\s+này",
    r"Trong\s+(?:Nghị định|Luật|Thông tư)\s+này",
    r"Tổ chức,\s*cá nhân",
    r"Điểm\s+[a-zđ]\b",
    r"Khoản\s+\d+\b",
    r"Cơ quan\s+(?:có thẩm quyền|quản lý)",
    r"Bộ\s+(?:trưởng|Nông nghiệp)",
    r"Tàu cá\b",
)
FUNCTION_WORDS = ("trong", "tại", "theo", "của", "và", "với", "về", "cho", "từ", "đến", "kèm", "bởi", "do", "hoặc", "như", "bằng")
POINT_LETTERS = "abcdđeghiklmnopqrstuưvxy"
CLAUSE_MARK = rf"(?:^|(?<=\s))(\d{{1,2}})\s*\.\s+(?=[{CLAUSE_UPPER}\d\"“(])"
POINT_MARK = r"(?:^|(?<=\s))([a-zđư])\)\s+"

# --- fixed values: protected tokens and blocks ---------------------------------------------------------------------
TOKENS = (
    r"\d{1,4}/\d{4}/[A-ZĐ]+(?:-[A-ZĐ]+)*",
    r"\b[A-Z]{2,6}\s?\d{1,5}(?:-\d{1,4})?:\d{4}(?:/[A-ZĐ\-]+)?",
    r"\b\d{1,2}/\d{1,2}/\d{4}\b",
    r"\b\d+[.,]\d+(?:\s*%|\s*mg/kg|\s*m2|\s*kg)?",
    r"\b[A-ZĐ]\.\d+(?:\.\d+)*",
    r"\b(?:TCVN|QCVN|ISO|TCN)\s*[\d\-:./]+",
)
SCALE_ITEM = r"(?:Cấp|Mức|Loại|Hạng|Bậc|Nhóm)\s+\d+\s*(?:\([^)]{0,30}\))?\s*:"
BLOCKS = (
    ("formula", r"[^.\n]{0,150}=\s*[^.\n]{1,250}(?:\.|$)"),
    ("scale", rf"{SCALE_ITEM}(?:(?!{SCALE_ITEM}).)*(?:{SCALE_ITEM}(?:(?!{SCALE_ITEM}).)*){{1,}}"),
    ("kv_run", rf"(?:[{UPPER}][^;:\n]{{2,70}}[:\s][^;\n]{{1,90}};\s*){{2,}}[^;\n]{{0,90}}\.?"),
    ("table", r"(?:Bảng|Biểu|Phụ lục|Mẫu số)\s+[A-ZĐ0-9IVX][\w.\-]*\s*[-–:]?[^.\n]{0,400}"),
    ("refs", r"(?:\[\d{1,3}\][^\[\n]{1,250}){2,}"),
)
ITEM_SEAM = r"(?:(?<=\s)|^)(?:(?:Cấp|Mức|Loại|Hạng|Bậc|Nhóm)\s+\d+\s*[(:]|Chỉ tiêu\b|Bảng\s|Biểu\s|Phụ lục\s|\[\d{1,3}\])|(?<=;)\s+"

# --- fixed values: boundaries, strongest first; the flag says whether the next piece begins at the match -------------
LEVELS = (
    ("dieu", True, r"(?:(?<=\s)|^)(?:Điều|Ðiều|ĐIỀU|Điền)\s+\d{1,3}[a-zđ]?\s*[.:]"),
    ("structure", True, r"(?:(?<=\s)|^)(?:Chương\s+[IVXLCDM]+|Mục\s+\d+\s*[.:]|Phụ lục\s+[A-ZĐIVX0-9]+)"),
    ("paragraph", False, r"\n[ \t]*\n"),
    ("khoan", True, rf"(?:(?<=\s)|^)\d{{1,2}}\.\s+(?=[{UPPER}\d])"),
    ("line", False, r"\n"),
    ("diem", True, r"(?:(?<=\s)|^)[a-zđư]\)\s+"),
    ("sentence", False, rf"(?<=[.!?])\s+(?=[{UPPER}\d\"“(\[])"),
    ("clause", False, r"(?<=;)\s+"),
    ("colon", False, r"(?<=:)\s+"),
)
ABBREVIATIONS = ("TS", "ThS", "GS", "PGS", "BS", "KS", "TP", "Q", "P", "Nxb", "St", "v.v", "vv", "tr")

# --- fixed values: boundary defects --------------------------------------------------------------------------------
TERMINALS = ".!?;…"
LABEL_TAIL = r"(?:Cấp|Mức|Loại|Hạng|Bậc|Nhóm|Chỉ tiêu|Bảng|Biểu|Điểm)\s*[\w.]*\s*:\s*$"
VALUE_HEAD = r"^\s*(?:[<>≤≥]|Từ\s|Trên\s|Dưới\s|\d+[.,]?\d*\s*(?:%|mg|kg|m2|ngày))"
CODE_TAIL = r"(?:\d{1,4}/\d{4}/$|/[A-ZĐ]{1,3}$|\b[A-Z]{3,5}\s*\d+-\d*:?$)"
ITEM_HEAD = r"^\s*(?:\[\d{1,3}\]|(?:Cấp|Mức|Loại|Hạng|Bậc|Nhóm)\s+\d+\s*[(:]|Chỉ tiêu\b|Bảng\s|Biểu\s|Phụ lục\s|[a-zđư]\)|\d{1,2}\.\s)"
MARKER_TAIL = r"(?:^|(?<=[.!?;])\s)(?:\d{1,2}\.|[a-zđư]\))\s*$"

# --- fixed values: audit -------------------------------------------------------------------------------------------
CHECKS = (
    ("dup_chunk_id", "FATAL", "two chunks share a chunk_id; the later one overwrites the earlier on upsert"),
    ("empty_content", "FATAL", "content is empty or whitespace"),
    ("char_len_mismatch", "FATAL", "char_len does not equal len(content)"),
    ("bad_json", "FATAL", "line is not valid JSON"),
    ("over_budget", "RAG", "longer than the embedder's window; the tail is silently truncated at index time"),
    ("no_dieu", "RAG", "no Điều title, so a retrieved hit cannot be cited"),
    ("title_guessed", "RAG", "title/body split was heuristic (flattened source), the title may be wrong"),
    ("no_link", "RAG", "no link/name, so the answer cannot show a source"),
    ("fragment_start", "RAG", "opens mid-sentence; reads as a fragment out of context"),
    ("orphan_part", "RAG", "part 2+ of an article without the title repeated in the text"),
    ("toc", "RAG", "table of contents: a list of Điều headings, not legal text"),
    ("boilerplate", "RAG", "signature block / distribution list / attachment notice"),
    ("too_short", "RAG", "below the useful floor; adds noise to the index"),
    ("exact_dup", "TRAINING", "identical text already seen"),
    ("near_dup", "TRAINING", "identical after normalising case, punctuation and whitespace"),
    ("template_dup", "INFO", "identical once numbers are folded too: either a repeated form, or two clauses that differ only in a figure -- read before dropping"),
    ("junk_ratio", "TRAINING", "mostly digits/punctuation: a table, a form, or dotted leaders"),
    ("all_caps", "TRAINING", "all upper case: a heading, not prose"),
    ("not_vietnamese", "TRAINING", "few common Vietnamese words; OCR garbage or another language"),
    ("self_repeating", "TRAINING", "the same phrase repeats inside one chunk"),
)
COMMON_WORDS = ("của", "và", "các", "được", "quy định", "tại", "theo", "này", "trong", "đối với", "cơ quan", "thực hiện", "khoản", "điều")
BOILERPLATE = ("Nơi nhận:", "TM. CHÍNH PHỦ", "KT. BỘ TRƯỞNG", "THỦ TƯỚNG CHÍNH PHỦ", "FILE ĐƯỢC ĐÍNH KÈM", "Lưu: VT", "(Đã ký)")
FRAGMENT_MARKS = (")", ";", ",", "-", "–", "+")

# --- fixed values: training examples -------------------------------------------------------------------------------
SYSTEM = (
    "Bạn là trợ lý pháp luật Việt Nam. Chỉ trả lời dựa trên các đoạn văn bản được "
    "cung cấp trong phần Ngữ cảnh. Luôn trích dẫn Điều và tên văn bản ở cuối câu "
    "trả lời. Nếu Ngữ cảnh không chứa thông tin cần thiết, hãy nói rõ là không tìm "
    "thấy căn cứ và không suy đoán."
)
REFUSAL = "Ngữ cảnh được cung cấp không chứa quy định trả lời cho câu hỏi này. Tôi không có căn cứ để trả lời."
DOCUMENT_KINDS = (
    ("thong-tu-lien-tich", "Thông tư liên tịch"), ("nghi-quyet", "Nghị quyết"), ("quyet-dinh", "Quyết định"), ("nghi-dinh", "Nghị định"),
    ("thong-tu", "Thông tư"), ("phap-lenh", "Pháp lệnh"), ("chi-thi", "Chỉ thị"), ("cong-van", "Công văn"), ("bo-luat", "Bộ luật"),
    ("luat", "Luật"), ("hien-phap", "Hiến pháp"), ("tieu-chuan", "Tiêu chuẩn"), ("quy-chuan", "Quy chuẩn"),
)
MANIFEST_INSTRUCTION = (
    "Đọc đoạn văn bản pháp luật dưới đây và viết 3 câu hỏi mà một "
    "người dân hoặc cán bộ có thể hỏi, kèm câu trả lời. Quy tắc: chỉ "
    "dùng thông tin có trong đoạn văn; giữ nguyên mọi con số; mỗi câu "
    "trả lời kết thúc bằng trích dẫn Điều và tên văn bản; nếu đoạn văn "
    "không đủ thông tin cho một câu hỏi thì bỏ câu hỏi đó. Trả về JSON "
    '{"pairs":[{"question":"...","answer":"..."}]}.'
)

# --- spellings for the JVM's regular expressions -------------------------------------------------------------------
#: White space as a class body, the same in the JVM, in DuckDB and for Python's \s.
WS = r"\t-\r\x1c-\x20\x85\p{Z}"


def jvm(pattern: str) -> str:
    r"""A pattern for the JVM: \s, \d and \w as explicit Unicode classes, $ as the very end."""
    out, i, inside = [], 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            c = pattern[i : i + 2]
            body = {"\\s": WS, "\\d": r"\p{Nd}", "\\w": r"\p{L}\p{N}_"}.get(c)
            out.append(body if body and inside else f"[{body}]" if body else {"\\b": r"(?U:\b)"}.get(c, c))
            i += 2
            continue
        if c == "[" and not inside:
            inside = True
        elif c == "[":
            c = r"\["
        elif c == "]" and inside:
            inside = False
        elif c == "$" and not inside:
            c = r"\z"
        elif c == "&" and inside:
            c = r"\&"
        out.append(c)
        i += 1
    return "".join(out)
