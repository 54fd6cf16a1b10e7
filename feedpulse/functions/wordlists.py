"""Word and letter lists of the default scorer and of the language filter.

Both are this project's own, written from general knowledge. The scorer's labels
therefore differ from those of any trained model; a trained model plugs into
``ModelScorer``. The language profiles are function words, and groups of letters for
posts with hardly any of those, so they hold for any topic.
"""

from __future__ import annotations

POSITIVE_WORDS = tuple(
    """
    amazing awesome beautiful best better brilliant calm charming cheerful clean clever
    delight delightful easy enjoy enjoyed excellent excited fantastic favorite fine friendly
    fun generous glad good gorgeous grateful great happy helpful hope impressive joy kind
    like love loved lovely lucky nice perfect pleasant pleased positive proud recommend
    reliable safe smart smooth superb support thank thanks win wonderful works worth
    """.split()
)

NEGATIVE_WORDS = tuple(
    """
    afraid angry annoying ashamed awful bad boring broken bug crap cruel damn dangerous
    dirty disappointed disappointing disgusting dumb evil fail failed failure fear garbage
    hate hated horrible hurt idiot idiots kill lazy liar lose lost loser mess nasty negative
    pain pathetic poor problem sad scam scary sick slow stupid terrible trash ugly unhappy
    upset useless waste weak worse worst wrong
    """.split()
)

_PROFILE_TEXT = """
de der die das und ist nicht ein eine mit für auf den dem von zu ich sie im auch sich
en the and of to is that it for was with as on are this be at by not you from
es de la el los las que y en una un por con para del se no es lo como pero
fr de la le les et des est une un dans que qui pour pas sur au avec ce il en
it di che è non una per sono con del della gli ma come più anche questo ho nel il si
nl de het een in en van ik is dat niet op te met voor zijn er maar ook bij wat
pl i w na nie się z do to że jest jak ale za po od tak o już co czy
pt de o que não uma para com os do da em um mas como mais por ao isso eu foi
sv och att det som en på är av för med den till inte om jag har de ett var så
"""

# Language code -> its words; one line above per language.
LANGUAGE_PROFILES = {
    line.split()[0]: tuple(line.split()[1:]) for line in _PROFILE_TEXT.strip().splitlines()
}

_LETTER_TEXT = """
de sch ch ei ie ung ü ö ä ß en er tz pf keit heit ck eu st
en th wh ea ou ee oo sh ck gh ow ay ly ld ew ing ed wi ph
es ñ ción ado os as ll rr que ez mente ía ó á í ue ie dad es
fr eau eux è ê ç é oi ai aux tion ou que ment elle qu oie â ier
it zione gli che ch tt zz ità cc gh ss ò ì ù ell ato are ere
nl ij aa ee oo uu sch gt cht ver ge lijk oe ui eu ng heid tje
pl cz sz rz ł ą ę ś ż ź ć ó ow ie dz ch ni wy prz
pt ção ã õ nh lh ç ões ê á ou ei em ar mento ss ó dade
sv å ä ö skt ig ade lig het ning sk ör är na ck tt nde ll
"""

# Language code -> letter groups that are common in it; one line above per language.
LETTER_PROFILES = {
    line.split()[0]: tuple(line.split()[1:]) for line in _LETTER_TEXT.strip().splitlines()
}
