"""Default parameters. Every operator takes these as arguments.

Fixed values: the word lists, host rules, base addresses, labels and the prompt
wording below decide results and are therefore stated as they are.
"""

ROLE_KEYWORDS = (
    "artist", "compositor", "generalist", "animator",
    "td", "technical", "pipeline", "developer",
    "programmer", "engineer", "graphics",
    "fx", "houdini", "nuke", "lighting",
    "modeller", "modeler", "rigger",
    "environment", "unreal", "unity",
    "producer", "coordinator", "supervisor",
    "lead", "head of", "intern", "trainee",
)

RELAXED_ROLE_KEYWORDS = (
    "artist", "compositor", "generalist", "animator",
    "td", "director", "pipeline", "developer",
    "producer", "coordinator", "fx", "houdini", "nuke",
    "modeller", "rigger", "lighting", "environment",
    "programmer", "engine", "graphics", "unreal", "unity",
    "supervisor", "lead", "head of", "intern", "trainee",
)

RELAXED_SKIP_TEXTS = ("privacy", "contact", "home", "about", "login", "read more")
RELAXED_HREFS = ("/job/", "/career/", "/apply")

POSITIVE_KEYWORDS = (
    "pipeline", "td", "technical", "python", "coordinator",
    "assistant", "runner", "atd", "mid", "automation", "tools",
    "developer", "data", "analyst", "programmer", "engineer", "devops", "software",
)

NEGATIVE_KEYWORDS = (
    "senior", "lead", "supervisor", "principal", "head", "chief",
    "finance", "hr", "legal", "accountant", "marketing", "sales",
    "art", "lighter", "animator", "modeler", "compositor", "Java", "concept", "JavaScript",
    "rigger", "fx",
)

# (text the host must contain, profile, label); the first that fits wins.
ATS_RULES = (
    ("teamtailor.com", "teamtailor", "Teamtailor"),
    ("greenhouse.io", "greenhouse", "Greenhouse"),
    ("boards.greenhouse.io", "greenhouse", "Greenhouse"),
    ("lever.co", "lever", "Lever"),
    ("ashbyhq.com", "ashby", "Ashby"),
    ("myworkdayjobs.com", "workday", "Workday"),
    ("smartrecruiters.com", "smartrecruiters", "SmartRecruiters"),
    ("workable.com", "workable", "Workable"),
)
FALLBACK_RULE = ("simple", "Simple/HTML")

# (text the address contains, company); the first that fits wins.
COMPANY_OVERRIDES = (("ilpvfx", "ilp"), ("fablefx", "fablefx"), ("filmgate", "filmgate"))
GENERIC_SUBDOMAINS = ("jobs", "careers", "career", "www")

# (code, substrings looked for in location and description); the first that fits wins.
COUNTRY_RULES = (
    ("FR", ("france", "paris", "lyon")),
    ("SE", ("sweden", "stockholm", "gothenburg", "malmo")),
)
OTHER_COUNTRY = "INT"

LANGUAGE_NAMES = {"FR": "FRENCH", "EN": "ENGLISH"}
LANGUAGE_LABELS = {
    "FR": {
        "cl_opening": "Madame, Monsieur,",
        "cl_closing": "Cordialement,",
        "h_profile": "Profil",
        "h_skills": "Compétences techniques",
        "h_experience": "Expérience professionnelle",
        "h_projects": "Projets",
        "h_education": "Formation",
        "h_attributes": "Compétences humaines",
    },
    "EN": {
        "cl_opening": "Dear Hiring Manager,",
        "cl_closing": "Sincerely,",
        "h_profile": "Profile",
        "h_skills": "Technical Skills",
        "h_experience": "Experience",
        "h_projects": "Projects",
        "h_education": "Education",
        "h_attributes": "Attributes",
    },
}

DESCRIPTION_CUT = 2500
PROMPT = """
You are a professional recruiter and ATS resume writer.

LANGUAGE: << language >>

JOB DESCRIPTION:
<< description >>

CANDIDATE PROFILE:
<< candidate >>

RETURN PURE JSON ONLY:
{
  "job_title_target": "<< title >>",
  "profile_summary": "2 sentences, first person",
  "experience_bullets": ["...", "...", "...", "..."],
  "cover_letter_body": "3 paragraphs separated by double newlines"
}
"""

SKILL_GROUPS = {
    "graphics": ("Vulkan", "OpenGL", "DirectX", "HLSL", "GLSL", "Rendering", "Shaders"),
    "engine": ("Unreal", "Unity", "Godot", "C++"),
    "general": ("Python", "Git", "CI/CD", "Docker", "C++", "Rigging", "Animation"),
}

ROLES_INCLUDE = (
    "Engineer", "Developer", "Programmer", "Technical Artist",
    "Producer", "Production", "Coordinator",
)
ROLES_SOFT_EXCLUDE = ("Manager", "Director", "Lead", "Intern")
