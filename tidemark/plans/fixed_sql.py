"""Fixed values as the SQL side has them, written out a second time: a wrong value on one side shows as a difference."""

# Rules over a lower-case title t, the first that matches wins.
FUNCTIONS = r"""CASE WHEN regexp_matches(t, '\b(chief of staff|strategy\s*&?\s*ops|corporate strategy)\b') THEN 'strategy' WHEN regexp_matches(t, '\b(product manager|technical product)\b') THEN 'product'
 WHEN regexp_matches(t, '\b(fp&a|financial planning|controller|treasurer|corporate accounting|finance manager|cfo)\b') THEN 'finance' WHEN regexp_matches(t, '\b(general counsel|legal counsel|attorney|compliance officer)\b') THEN 'legal'
 WHEN regexp_matches(t, '\b(data scientist|data analyst|analytics engineer|ml engineer)\b') THEN 'data_science' WHEN regexp_matches(t, '\b(policy|government affairs|regulatory affairs|public affairs)\b') THEN 'policy'
 WHEN regexp_matches(t, '\b(marketing|brand|content|communications|pr|public relations|growth)\b') THEN 'marketing' WHEN regexp_matches(t, '\b(business development|bd|partnerships|sales ops|account executive|account manager|account rep)\b') THEN 'sales'
 WHEN regexp_matches(t, '\b(procurement|logistics|materials|supply chain|planning)\b') THEN 'supply_chain' WHEN regexp_matches(t, '\b(program manager|project manager|operations manager|ops manager)\b') THEN 'operations'
 WHEN regexp_matches(t, '\b(people operations|recruiter|talent|hrbp|hr business|human resources)\b') THEN 'hr' WHEN regexp_matches(t, '\b(customer success|customer support|renewals|implementation specialist)\b') THEN 'customer_success'
 WHEN regexp_matches(t, '\b(product designer|ux|ui designer|visual designer|graphic designer)\b') THEN 'design' WHEN regexp_matches(t, '\b(engineer|developer|architect|swe|sde|devops|sre|platform)\b') THEN 'engineering' END"""
LEVELS = r"""CASE WHEN regexp_matches(t, '\b(intern|internship)\b') THEN 'intern' WHEN regexp_matches(t, '\b(ceo|cto|coo|cfo|cpo|chief\s+\w+\s+officer)\b') THEN 'c_suite' WHEN regexp_matches(t, '\b(vp|vice president)\b') THEN 'vp'
 WHEN regexp_matches(t, '\b(director|head of)\b') THEN 'director' WHEN regexp_matches(t, '\b(staff|principal)\b') THEN 'staff' WHEN regexp_matches(t, '\b(senior|sr|lead)\b') THEN 'senior' WHEN regexp_matches(t, '\b(junior|jr|associate|entry)\b') THEN 'entry'
 WHEN regexp_matches(t, '\bmanager\b') AND NOT regexp_matches(t, '\b(people|engineering|product|program|project|general|senior)\s+manager\b') THEN 'mid' ELSE 'unknown' END"""
EMPLOYMENTS = r"""CASE WHEN regexp_matches(t, '\b(intern|internship)\b') THEN 'intern' WHEN regexp_matches(t, '\b(contract|contractor|consultant)\b') THEN 'contract' WHEN regexp_matches(t, '\bpart[- ]time\b') THEN 'part_time' ELSE 'full_time' END"""
RELEVANCE = """CASE WHEN fn IS NULL OR sen = 'unknown' THEN NULL WHEN fn IN ('strategy', 'finance', 'product', 'legal', 'policy') AND sen IN ('mid', 'senior', 'staff', 'director', 'vp', 'c_suite') THEN 'high'
 WHEN sen = 'intern' THEN 'low' WHEN fn IN ('engineering', 'hr', 'customer_success') AND sen IN ('intern', 'entry') THEN 'low' ELSE 'medium' END"""
NORMAL_TITLE = "title"
for _short, _long in (("Sr", "Senior"), ("Jr", "Junior"), ("Eng", "Engineer"), ("Mgr", "Manager"), ("Dir", "Director"), ("Assoc", "Associate")):
    NORMAL_TITLE = f"regexp_replace({NORMAL_TITLE}, '\\b{_short}\\.?(\\s|$)', '{_long}\\1', 'gi')"
NORMAL_TITLE = f"regexp_replace({NORMAL_TITLE}, ' (I{{1,3}}|IV|VI{{0,3}}|IX|[1-9])$', '', 'i')"
TRANSIENT = "('transient_network', 'rate_limit', 'timeout')"
# Addresses and pages.
LISTING = "jobs?|careers|career|opportunities|openings|positions|vacancies"
NO_LISTING = r"^#|^mailto:|^javascript:|^tel:|linkedin\.com|facebook\.com|instagram\.com"
LISTING_LINK = (
    r"greenhouse\.io|boards\.greenhouse|jobs\.lever\.|\.lever\.co/jobs|myworkdayjobs\.com|ashbyhq\.com|[a-z0-9.-]+\.careers/|/careers[-_][a-z0-9]|/jobs?[-_][a-z0-9]|"
    r"/(jobs?|careers|career|opportunities|openings|positions|vacancies)(/|$|\?)|job-position/|/job-opening|/jobposting"
)
DENIED = "['privacy', 'privacy-policy', 'terms', 'terms-of-use', 'terms-and-conditions', 'contact', 'blog', 'press', 'legal']"
BLOCKED = "captcha|please enable cookies|access denied|cookie consent|you are being redirected"
PLATFORM = r"""CASE WHEN regexp_matches(p, 'boards\.greenhouse\.io|greenhouse-io|id\s*=\s*"grnhse_app"') THEN 'greenhouse' WHEN regexp_matches(p, 'jobs\.lever\.co') THEN 'lever'
 WHEN regexp_matches(p, 'jobs\.ashbyhq\.com|ashby-job-posting') THEN 'ashby' WHEN contains(p, 'myworkdayjobs.com') THEN 'workday' WHEN regexp_matches(p, 'app\.rippling\.com/jobs|rippling-ats') THEN 'rippling'
 WHEN regexp_matches(p, 'jobs\.jobvite\.com|jobvite-widget') THEN 'jobvite' WHEN contains(p, 'icims.com') THEN 'icims' WHEN regexp_matches(p, 'jobs\.smartrecruiters\.com|smartrecruiters-widget') THEN 'smartrecruiters'
 WHEN contains(p, 'apply.workable.com') THEN 'workable' WHEN contains(p, '.recruitee.com') THEN 'recruitee' WHEN contains(p, 'teamtailor.com') THEN 'teamtailor' WHEN contains(p, '.bamboohr.com') THEN 'bamboohr' END"""
