"""Names, word lists, patterns, formats and reply texts.

Everything here is data that results are compared against; no logic.
"""

from __future__ import annotations

from typing import NamedTuple


class Agent(NamedTuple):
    """One kind of work: who does it, as which principal, and its event names."""

    name: str
    principal: str
    label: str
    job: str
    started: str
    completed: str
    failed: str
    budget_minutes: int | None
    timeout_minutes: int | None


# Agents, principals, event types, time budgets and job timeouts.
EXTRACTION = Agent(
    "extraction_agent", "EXTRACTION_SP", "Extraction", "extraction",
    "ExtractionJobStarted", "ExtractionJobCompleted", "ExtractionJobFailed", 30, 60,
)
SUMMARIZATION = Agent(
    "summarization_agent", "SUMMARIZATION_SP", "Summarization", "summarization",
    "SummarizationJobStarted", "SummarizationJobCompleted", "SummarizationJobFailed", 10, 30,
)
UPLOAD = Agent(
    "sharepoint_agent", "SHAREPOINT_SP", "Upload", "sharepoint",
    "SharePointUploadStarted", "SharePointUploadCompleted", "SharePointUploadFailed", None, None,
)
AGENTS = (EXTRACTION, SUMMARIZATION, UPLOAD)
JOB_STARTED = "JobStarted"

# Fixed value: the run id that stands for "no run" in failure and upload events.
NO_RUN = 0

# Workflow stages and statuses.
EXTRACTING, SUMMARIZING, UPLOADING, DONE = "extracting", "summarizing", "uploading", "completed"
IN_PROGRESS, WF_COMPLETED, WF_FAILED = "in_progress", "completed", "failed"
ACTIVE_JOB_STATUSES = ("PENDING", "RUNNING")
FINISHED_JOB_STATUSES = ("SUCCESS", "FAILED")

# Intent word lists, in the order in which they are tried.
INTENTS = (
    ("extract_document", ("extract", "process", "parse", "/source_pdfs/")),
    ("check_status", ("status", "progress", "check", "run id")),
    ("search_knowledge", ("search", "find", "tell me about", "what is")),
)
GENERAL_INTENT = "general"
REFRESH_WORDS = ("refresh", "update", "stale", "old")

# Path rules and patterns.
PDF_SUFFIX = ".pdf"
SOURCE_PREFIX = "/source_pdfs/"
SOURCE_PATH_PATTERN = r"/source_pdfs/[^\s]+\.pdf"
VOLUME_MARK = "/Volumes/"
BAD_SUFFIX = "Only PDF files are supported"
BAD_PREFIX = "PDFs must be in /source_pdfs/ directory"
PAGE_BREAK = "\n\n"

# Patterns of personal data; the first two are the named filters, the others
# the usual kinds of contact data.
PII_PATTERNS = {
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "credit_card": r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}",
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "phone": r"\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}",
}

# A character that every match of the pattern contains.
PII_MARKS = {"ssn": "-", "email": "@", "phone": "+"}

# The file written for a summary.
SUMMARY_FILE_PREFIX = "oncology_summary_"
SUMMARY_TITLE = "ONCOLOGY SUMMARY - Patient "
SUMMARY_RULE = "=" * 80

# The two messages sent to the summary model.
SYSTEM_PROMPT = """You are a medical AI assistant specializing in oncology. 
Summarize the following oncology document in a structured clinical format. 

Your summary should include:
1. **Patient Demographics** (if available)
2. **Diagnosis** with staging
3. **Biomarker Status**
4. **Treatment Recommendations**
5. **Prognosis**
6. **Key Clinical Notes**

Format your response as a professional clinical summary suitable for medical records."""
USER_PROMPT = "Please summarize this oncology report:\n\n"

# Reply texts; {names} are filled from columns.
MSG_EMPTY = "Please provide a message."
MSG_NO_PATH = "Please specify a document path. Example: 'Extract /source_pdfs/patient_123.pdf'"
MSG_NO_VOLUME_PATH = "Please provide a document path like: Extract /Volumes/catalog/schema/volume/file.pdf"
MSG_NO_WORKFLOW = "You don't have any workflows in progress."
MSG_NO_KNOWLEDGE = "No relevant information found in the knowledge base."
MSG_NO_PRODUCTS = "I couldn't find any relevant products."
MSG_PREVIOUS_DONE = "Your previous workflow is complete! How can I help you today?"
MSG_UNKNOWN_STATE = "Workflow in unknown state. Please contact support."
MSG_NOT_FOUND = "No {job} job found with Run ID {run_id}"
MSG_JOB_COMPLETED = "{label} completed successfully!"
MSG_JOB_FAILED = "{label} failed"
MSG_JOB_RUNNING = "{label} in progress... ({elapsed} min elapsed, ETA: {eta} min)"
MSG_NOT_COMPLETED = "{label} run {run_id} not completed or failed"
MSG_NO_SUMMARY = "No summary found for run {run_id}"
MSG_STAGE_FAILED = "❌ {label} failed: {message}"
MSG_NEXT_STEPS = (
    "I'll notify you when extraction completes. You can ask other questions in the meantime."
)
MSG_STARTED = """📄 **Extraction Started!**

**Document:** {path}  
**Run ID:** {run_id}  
**ETA:** {eta} minutes

{next_steps}

💡 **What happens next:**
1. PDF extraction (~30 min)
2. Automatic summarization (~10 min)
3. Upload to SharePoint
4. You'll be notified at each step

Feel free to ask other questions while I process this!"""
MSG_TO_SUMMARY = """✅ **Extraction Complete!** {message}

📝 **Summarization Started!**  
**Run ID:** {run_id}  
**ETA:** {eta} minutes

The document is now being summarized. I'll let you know when it's ready!"""
MSG_EXTRACTING = """📄 **Extraction In Progress...**

{message}

💡 Your document is being processed. I'll notify you when it's ready!  
In the meantime, feel free to ask other questions."""
MSG_UPLOADED = """🎉 **Workflow Complete!**

✅ Extraction: Done  
✅ Summarization: Done  
✅ SharePoint Upload: Done

📎 **Document URL:** {url}

Your document has been processed and is now available in SharePoint!"""
MSG_SUMMARIZING = """📝 **Summarization In Progress...**

{message}

The summary will be automatically uploaded to SharePoint when complete."""
MSG_GENERAL = """I'm the Oncology Document Processing Assistant. I can help you:

📄 **Extract documents:** "Extract /source_pdfs/patient_123.pdf"  
📝 **Check status:** "What's the status of my workflow?"  
📚 **Search knowledge:** "Tell me about treatment protocols"

What would you like to do?"""
MSG_VOLUME_STARTED = "✅ Extraction started for {path}\n🔗 Run ID: {run_id}"
MSG_VOLUME_HELP = "I can help you extract oncology documents. Say 'Extract /Volumes/.../file.pdf' to start."
MSG_REFRESH = """✅ Data refresh triggered successfully!

Job is running in the background (Run ID: {run_id})
Please retry your question in 2-3 minutes once the data is refreshed."""
MSG_NO_QUESTION = "I didn't receive a question."
MSG_SAVED = "✅ Summary saved!\n\nFile: {name}\nLocation: {path}"
MSG_NOT_SAVED = "❌ Save failed: {error}"
KNOWLEDGE_REPLY = """📚 **Knowledge Base Results:**

{results}

💡 This information is from our medical literature database."""
KNOWLEDGE_HIT = "**{title}**\n{preview}...\nSource: {source}"
PRODUCT_HEADER = "Here are the relevant products:\n"
PRODUCT_HIT = "• **{name}** ({category}) - ${price}"
