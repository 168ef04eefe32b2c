"""Word lists and patterns that the rules depend on, English and Spanish. Patterns hold for folded, lower-case text."""

# They decide results and must not be changed.
MESSAGE_CTAS = [
    "MESSAGE_PAGE", "SEND_MESSAGE", "WHATSAPP_MESSAGE", "CONTACT_US",
]
MESSAGE_URLS = [
    r"m\.me/", r"messenger\.com", r"wa\.me/", r"api\.whatsapp\.com", r"ig\.me/",
]
CALL_CTAS = [
    "CALL_NOW", "CALL",
]
CALL_URLS = [
    "^tel:", "click-to-call",
]
FORM_CTAS = [
    "APPLY_NOW", "SIGN_UP", "GET_QUOTE", "REQUEST_TIME", "BOOK_TRAVEL", "BOOK_NOW", "CONTACT_US",
]
FORM_URLS = [
    "/lead[-_]?form", "/contact[-_]?us", "/get[-_]?quote", "/apply", "/book", "/schedule", r"typeform\.com", r"calendly\.com", r"forms\.gle",
    r"jotform\.com", "hubspot.*form",
]
LEAD_CTAS = [
    "SIGN_UP", "LEARN_MORE", "APPLY_NOW", "GET_QUOTE", "BOOK_NOW", "CONTACT_US", "BOOK_TRAVEL", "REQUEST_TIME",
]
SHOP_CTAS = [
    "SHOP_NOW", "BUY_NOW", "BUY_TICKETS", "ORDER_NOW", "DOWNLOAD", "INSTALL_APP", "INSTALL_MOBILE_APP", "USE_APP", "PLAY_GAME", "SUBSCRIBE",
]
SHOP_DOMAINS = [
    "shopify.com", "myshopify.com", "stripe.com", "gumroad.com", "square.com", "squareup.com", "play.google.com", "apps.apple.com", "amazon.com",
    "amazon.", "etsy.com", "ebay.com", "paypal.com", "checkout.stripe.com",
]
SHOP_PATHS = [
    "/checkout", "/cart", "/product/", "/products/", "/buy/", "/shop/", "/add-to-cart", "/purchase", "/order/",
]
PRICES = [
    r"\$\d+", r"\d+%\s*off", r"free\s+shipping", r"sale\s+ends", r"buy\s+now", r"order\s+now", r"limited\s+stock", r"add\s+to\s+cart", r"promo\s+code",
    r"discount\s+code", "coupon",
]
FOLLOW_UP = [
    r"\bwe'll\s+(call|contact|reach)", r"\bwe\s+will\s+(call|contact|reach)", r"\bexpect\s+a\s+call\b", r"\bsomeone\s+will\s+(call|contact)",
    r"\ba\s+representative\s+will", r"\bour\s+team\s+will\s+contact", r"\bte\s+contactamos\b", r"\bte\s+llamamos\b", r"\bnos\s+comunicamos\b",
    r"\bun\s+asesor\s+te\s+(llamara|contactara)",
]
CONSULT = [
    r"\bapply\b", r"\beligib", r"\bqualify\b", r"\brequirements?\b", r"\bwe'll\s+contact\b", r"\bwe\s+will\s+contact\b", r"\bspeak\s+with\b",
    r"\btalk\s+to\b", r"\bassessment\b", r"\bpre-qualify\b", r"\bscreening\b", r"\bschedule\b", r"\bbook\b", r"\bconsult\b", r"\bquote\b",
    r"\bconsultation\b", r"\bappointment\b", r"\bget\s+in\s+touch\b", r"\bfree\s+consultation\b", r"\bfree\s+estimate\b", r"\bfree\s+quote\b",
    r"\bcalifica\b", r"\belegible\b", r"\brequisitos\b", r"\bagenda\b", r"\bcita\b", r"\bcotiza\b", r"\bte\s+contactamos\b", r"\bsolicita\b",
    r"\bevaluacion\b", r"\basesoria\b", r"\bllamada\b", r"\bconsulta\b", r"\bpresupuesto\b", r"\bgratis\b", r"\bsin\s+costo\b", r"\bagenda\s+tu\b",
    r"\bagenda\s+una\s+llamada\b",
]
QUALIFICATION = [
    r"\bapply\b", r"\beligib", r"\bqualify\b", r"\brequirements?\b", r"\bapproval\b", r"\bwe\s+will\s+contact\b", r"\bspeak\s+with\b",
    r"\btalk\s+to\b", r"\bget\s+in\s+touch\b", r"\bassessment\b", r"\bpre-qualify\b", r"\bscreening\b", r"\bdo\s+you\s+qualify\b",
    r"\bare\s+you\s+eligible\b", r"\bmeet\s+requirements\b", r"\bcriteria\b", r"\bcheck\s+your\s+eligibility\b", r"\bcalifica\b", r"\belegible\b",
    r"\brequisitos\b", r"\bagenda\s+una\s+llamada\b", r"\bcotiza\b", r"\bte\s+contactamos\b", r"\bsolicita\b", r"\bevaluacion\b", r"\bverifica\s+tu\b",
    r"\bcumples\s+con\b",
]
BOOKING = [
    r"\bbook\b", r"\bschedule\b", r"\bconsult\b", r"\bquote\b", r"\bapply\b", r"\bappointment\b", r"\bestimate\b", r"\bagenda\b", r"\bcita\b",
    r"\bllamada\b", r"\basesoria\b", r"\bcotizacion\b", r"\bpresupuesto\b",
]
FIT_QUALIFICATION = [
    r"\brequirements?\b", r"\beligib", r"\bqualify\b", r"\bapproval\b", r"\bpre[-\s]?qual", r"\bfinanc", r"\blicensed?\b", r"\binsurance\b",
    r"\bestimate\b", r"\bcredit\s+(check|score)\b", r"\bincome\s+verification\b", r"\bassessment\b", r"\bscreening\b", r"\bevaluat",
    r"\breview\s+your\b", r"\bcheck\s+your\b", r"\brequisitos\b", r"\bcalifica\b", r"\belegible\b", r"\baprobado\b", r"\baprobacion\b",
    r"\bfinanciamiento\b", r"\blicencia\b", r"\bseguro\b", r"\bcotizacion\b", r"\bestimacion\b", r"\bcredito\b", r"\bevaluacion\b",
    r"\bverificacion\b", r"\brevision\b",
]
FIT_FOLLOW_UP = [
    r"\bwe('ll|\s+will)\s+(call|contact|reach|get\s+back)", r"\bexpect\s+a\s+(call|response)\b", r"\bsomeone\s+will\s+(call|contact)",
    r"\bour\s+team\s+will\s+(call|contact|reach)", r"\brespond\s+within\s+\d+", r"\bget\s+back\s+to\s+you\b", r"\bhear\s+from\s+us\b",
    r"\ba\s+representative\s+will\b", r"\bcall\s+you\s+back\b", r"\bte\s+contactamos\b", r"\bte\s+llamamos\b", r"\bnos\s+comunicamos\b",
    r"\bun\s+asesor\s+te\b", r"\bespera\s+(una\s+)?llamada\b", r"\brespuesta\s+en\s+\d+",
]
MULTI_STEP = [
    r"\banswer\s+(a\s+few|some)\s+questions?\b", r"\bfill\s+out\s+(a|the|this)\s+form\b", r"\bcomplete\s+(a|the|this)\s+(short\s+)?form\b",
    r"\bstep\s+\d+\b", r"\bfirst\s+step\b", r"\bnext\s+step\b", r"\bget\s+started\b", r"\bstart\s+your\b", r"\btells?\s+us\s+about\b",
    r"\blearn\s+more\s+about\s+you\b", r"\bshort\s+(quiz|survey|form)\b", r"\bresponde\s+(unas|algunas)\s+preguntas?\b",
    r"\bllena\s+(el|este)\s+formulario\b", r"\bcompleta\s+(el|este)\s+formulario\b", r"\bpaso\s+\d+\b", r"\bprimer\s+paso\b", r"\bcomienza\b",
    r"\binicia\b",
]
ADVISOR = [
    r"\badvisor\b", r"\bspecialist\b", r"\bexpert\b", r"\bconsultant\b", r"\bour\s+team\b", r"\bspeak\s+with\s+(an?|our)\b",
    r"\btalk\s+to\s+(an?|our)\b", r"\bpersonal\s+(advisor|consultant|specialist)\b", r"\bdedicated\s+(rep|representative|agent)\b",
    r"\bprofessional\b", r"\banalyst\b", r"\bagent\b", r"\basesor\b", r"\bespecialista\b", r"\bexperto\b", r"\bconsultor\b", r"\bequipo\b",
    r"\bhabla\s+con\s+(un|nuestro)\b", r"\bprofesional\b", r"\bagente\b", r"\brepresentante\b",
]
SERVICE_BREADTH = [
    r"\bwe\s+help\s+(with|you)\b", r"\bwe\s+offer\b", r"\bour\s+services\b", r"\bservices\s+include\b", r"\bwide\s+range\b", r"\bvariety\s+of\b",
    r"\btalk\s+to\s+us\s+about\b", r"\bcontact\s+us\s+for\b", r"\blearn\s+more\s+about\b", r"\bfind\s+out\s+(how|what)\b", r"\blet\s+us\s+help\b",
    r"\bcustomized?\s+solutions?\b", r"\btailored\s+to\b", r"\byour\s+needs\b", r"\bwhatever\s+you\s+need\b", r"\bte\s+ayudamos\b", r"\bofrecemos\b",
    r"\bnuestros\s+servicios\b", r"\bamplia\s+gama\b", r"\bvariedad\s+de\b", r"\bsoluciones\s+personalizadas\b", r"\btus\s+necesidades\b",
]
REGULATED_DOMAIN = [
    r"\battorney\b", r"\blawyer\b", r"\blaw\s+firm\b", r"\blegal\b", r"\babogado\b", r"\bschool\b", r"\buniversity\b", r"\bcollege\b",
    r"\beducation\b", r"\btraining\b", r"\bcertification\b", r"\bcdl\b", r"\btruck\s+driving\b", r"\bescuela\b", r"\bcapacitacion\b", r"\bmedical\b",
    r"\bhealthcare\b", r"\bdoctor\b", r"\bdentist\b", r"\bclinic\b", r"\btreatment\b", r"\btherapy\b", r"\bcounseling\b", r"\bhospital\b",
    r"\bsalud\b", r"\bmedico\b", r"\bmortgage\b", r"\bloan\b", r"\bfinancing\b", r"\bcredit\b", r"\bdebt\b", r"\btax\b", r"\baccounting\b",
    r"\bbookkeeping\b", r"\bhipoteca\b", r"\bprestamo\b", r"\bcredito\b", r"\breal\s+estate\b", r"\bhomes?\s+for\b", r"\bproperty\b", r"\bhousing\b",
    r"\bapartment\b", r"\brental\b", r"\binmobiliaria?\b", r"\bbienes\s+raices\b", r"\binsurance\b", r"\bcoverage\b", r"\bpolicy\b", r"\bseguro\b",
]
REGULATED_CATEGORIES = [
    "lawyer & law firm", "legal service", "attorney", "school", "college & university", "education", "trade school", "driving school",
    "vocational school", "educational consultant", "doctor", "dentist", "medical & health", "hospital", "clinic", "mental health service", "therapist",
    "counselor", "financial service", "bank", "mortgage brokers", "loan service", "accountant", "tax preparation service", "financial planner",
    "real estate", "real estate agent", "property management company", "real estate service", "real estate investment firm", "insurance company",
    "insurance agent", "insurance broker",
]
IMMEDIACY = [
    r"\btoday\b", r"\bnow\b", r"\basap\b", r"\bimmediately\b", r"\burgent\b", r"\blimited\s+time\b", r"\blast\s+chance\b", r"\bcall\s+now\b",
    r"\bbook\s+today\b", r"\bschedule\s+now\b", r"\binstant\s+quote\b", r"\bfree\s+consultation\b", r"\b24/7\b", r"\bsame\s+day\b", r"\bnext\s+day\b",
    r"\bavailable\s+now\b", r"\bready\s+to\s+move\b", r"\bdon\'t\s+wait\b", r"\bdon't\s+wait\b", r"\bact\s+now\b", r"\bwhile\s+supplies\s+last\b",
    r"\bhoy\b", r"\bahora\b", r"\bya\b", r"\burgente\b", r"\binmediato\b", r"\bllamanos\b", r"\bagenda\s+hoy\b",
]
URGENT_QUALIFICATION = [
    r"\bpre[-\s]?qualify\b", r"\beligib", r"\bapply\b", r"\brequirements?\b", r"\bqualify\b", r"\bcriteria\b", r"\bapproval\b", r"\bassessment\b",
    r"\bevaluation\b", r"\bdo\s+you\s+qualify\b", r"\bare\s+you\s+eligible\b", r"\bcheck\s+your\s+eligibility\b", r"\bcalifica\b", r"\brequisitos\b",
    r"\bevaluacion\b", r"\baprobacion\b",
]
CONTENT = [
    r"\bnovel\b", r"\bstory\b", r"\bstories\b", r"\bfiction\b", r"\bdrama\b", r"\bshorts\b", r"\bepisode\b", r"\bepisodes\b", r"\bchapter\b",
    r"\bchapters\b", r"\bwatch\b", r"\bstream\b", r"\bseries\b", r"\bmovie\b", r"\bfilm\b", r"\btrailer\b", r"\bwebnovel\b", r"\bwattpad\b",
    r"\bfanfic\b", r"\bclip\b", r"\bviral\b", r"\bmeme\b", r"\bfunny\b", r"\blol\b", r"\bromance\b", r"\bthriller\b",
]
REGULATED_NAMES = [
    r"\brealt[yo]r?\b", r"\brealty\b", r"\breal\s*estate\b", r"\bproperty\s*(group|management)?\b", r"\bmortgage\b", r"\blending\b",
    r"\bhomes?\s+(by|for|of)\b", r"\bre/max\b", r"\bkeller\s*williams\b", r"\bcentury\s*21\b", r"\bcoldwell\s*banker\b", r"\bsotheby\b", r"\bbroker\b",
    r"\battorney\b", r"\blaw\s*(firm|office|group)?\b", r"\blegal\s*(services?)?\b", r"\babogado\b", r"\besq\.?\b", r"\bmedical\b", r"\bdental\b",
    r"\bdentist\b", r"\bclinic\b", r"\bdoctor\b", r"\bdr\.\s", r"\bmd\b", r"\bdds\b", r"\bchiropractic\b", r"\btherapy\b", r"\bcounseling\b",
    r"\bcpa\b", r"\baccountant\b", r"\baccounting\b", r"\btax\s*(services?|prep)?\b", r"\bfinancial\s*(advisor|planning|services?)?\b",
    r"\badvisory\b", r"\bwealth\s*management\b", r"\binsurance\b", r"\ballstate\b", r"\bstate\s*farm\b", r"\bgeico\b", r"\bprogressive\b",
    r"\bschool\b", r"\bacademy\b", r"\buniversity\b", r"\bcollege\b", r"\binstitute\b", r"\btraining\s*(center)?\b", r"\bcdl\b", r"\broofing\b",
    r"\bplumbing\b", r"\bhvac\b", r"\belectrical\b", r"\bcontractor\b", r"\bconstruction\b", r"\bremodel\b", r"\brenovation\b", r"\bpainting\b",
    r"\bcoatings\b", r"\bglass\s*(doctor|repair)?\b", r"\brepair\s*(service)?\b", r"\bauto\s*(sales|deal|group)\b", r"\bcar\s*(sales|dealer)\b",
    r"\btruck\s*(sales)?\b", r"\btrailer\s*(sales)?\b", r"\bdealership\b", r"\bconsulting\b", r"\bconsultant\b", r"\bservices?\s*(llc|inc|co)?\b",
]
GENERIC_CTAS = ["CALL_NOW", "MESSAGE_PAGE", "SEND_MESSAGE", "WHATSAPP_MESSAGE", "CONTACT_US"]
DECISION_MAKERS = ["owner", "broker", "founder", "principal", "ceo", "president", "director", "managing", "partner"]
