"""Public suffixes of two labels."""

from __future__ import annotations

# Second-level names that are open to everybody or to a kind of holder, each with the country codes
# under which it is a public suffix. Regional and private suffixes are left out.
_UNDER = {
    "ac": (
        "ae at bd be ci ck cn cr cy er fj fk gn id il im in ir jm jp ke kh kr lk ls ma me mm mu mw mz ni np "
        "nz pa pg pr rs rw se sz th tj tz ug uk vn za zm zw"
    ),
    "co": (
        "ae ag am ao at bb bd bi bw ci ck cl cm cr er fk gg gl gy hu id il im in ir it je jm jp ke kh kr lc "
        "ls ma me mg mm mu mw mz na ni np nz om pg pn pw rs rw st sz th tj tm tt tz ug uk us uz ve vi za zm "
        "zw"
    ),
    "com": (
        "ac af ag ai al am ar au aw az ba bb bd bh bi bm bn bo br bs bt by bz ci ck cm cn co cu cv cw cy dm "
        "do dz ec ee eg er es et fj fk fm fr ge gh gi gl gn gp gr gt gu gy hk hn hr ht im in io iq is jm jo "
        "kg kh ki km kp kw ky kz la lb lc lk lr lv ly mg mk ml mm mo ms mt mu mv mw mx my na nf ng ni np nr "
        "om pa pe pf pg ph pk pl pr ps pt py qa re ro sa sb sc sd sg sh sl sn so ss st sv sy tj tm tn to tr "
        "tt tw ua ug uy uz vc ve vi vn vu ws ye zm"
    ),
    "edu": (
        "ac af al ar au az ba bb bd bh bi bm bn bo br bs bt bz ci ck cn co cu cv cw dm do dz ec ee eg er es "
        "et fk fm gd ge gh gi gl gn gp gr gt gu gy hk hn ht in iq is it jm jo kg kh ki km kn kp kw ky kz la "
        "lb lc lk lr ls lv ly me mg mk ml mm mn mo ms mt mv mw mx my mz ng ni np nr om pa pe pf pg ph pk pl "
        "pn pr ps pt py qa rs sa sb sc sd sg sl sn so ss st sv sy tj tm to tr tt tw ua uy vc ve vn vu ws ye "
        "za zm"
    ),
    "go": "ci cr id it jp ke kr pw th tj tz ug",
    "gob": "ar bo cl do ec es gt hn mx ni pa pe pk sv ve",
    "gouv": "bj ci fr ht km ml sn",
    "gov": (
        "ac ae af al ar as au az ba bb bd bf bh bm bn br bs bt by bz cd ck cl cm cn co cu cx cy dm do dz ec "
        "ee eg er et fj fk gd ge gh gi gn gr gu gy hk ie il in iq ir is it jm jo kg kh ki km kn kp kw kz la "
        "lb lc lk lr ls lt lv ly ma me mg mk ml mm mn mo mr ms mu mv mw my mz ng np nr om pg ph pk pl pn pr "
        "ps pt py qa rs rw sa sb sc sd sg sh sl so ss sx sy tj tl tm tn to tr tt tw ua uk vc ve vn ws ye za "
        "zm zw"
    ),
    "ltd": "cy gi lk uk",
    "mil": (
        "ac ae al ar az ba bd bo br by ck cl cn co cy do ec eg er fj fk ge gh gt hn id in iq jm jo kg kh km "
        "kr kz lv mg mm mv my mz ng ni no np nz pe pg ph pl py qa rw sh st sy tj tm to tr tw tz uy vc ve ye "
        "za zm zw"
    ),
    "ne": "jp ke kr pw tz ug us",
    "net": (
        "ac ae af ag ai al am ar au az ba bb bd bh bm bn bo br bs bt bz ci ck cm cn co cu cw cy dm do dz ec "
        "eg er et fj fk fm ge gg gl gn gp gr gt gu gy hk hn ht id il im in iq ir is je jm jo kg kh ki kn kw "
        "ky kz la lb lc lk lr ls lv ly ma me mk ml mm mo ms mt mu mv mw mx my mz nf ng ni np nr nz om pa pe "
        "pg ph pk pl pn pr ps pt py qa rw sa sb sc sd sg sh sl so ss st sy th tj tm tn to tr tt tw ua uk uy "
        "uz vc ve vi vn vu ws ye za zm"
    ),
    "nom": "ad ag co es fr km mg nc ni pa pe pl re ro tm ve za",
    "or": "at bi ci cr id it jp ke kr mu na pw th tz ug us",
    "org": (
        "ac ae af ag ai al am ar au az ba bb bd bh bi bm bn bo br bs bt bw bz ci ck cn co cu cv cw cy dm do "
        "dz ec ee eg er es et fj fk fm ge gg gh gi gl gn gp gr gt gu gy hk hn ht hu il im in iq ir is je jm "
        "jo kg kh ki km kn kp kw ky kz la lb lc lk lr ls lv ly ma me mg mk ml mm mn mo ms mt mu mv mw mx my "
        "mz na ng ni np nr nz om pa pe pf pg ph pk pl pn pr ps pt py qa ro rs rw sa sb sc sd se sg sh sl sn "
        "so ss st sv sy sz tj tm tn to tr tt tw ua ug uk uy uz vc ve vi vn vu ws ye za zm zw"
    ),
    "plc": "ly uk",
    "sch": "ae id ir jo lk ly ng qa sa ss zm",
}

DOUBLE_SUFFIXES = tuple(f"{label}.{code}" for label, codes in _UNDER.items() for code in codes.split())
