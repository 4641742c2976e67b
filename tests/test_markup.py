from pyspark.sql import functions as F
from textloom.functions.markup import render

from .test_text import values

CASES = {
    "quest": {
        "": "",
        "plain <b> & \"x\"": "plain &lt;b&gt; &amp; &quot;x&quot;",
        "&6Gold&r end": '<span style="color:#FFAA00">Gold</span> end',
        "&lbold &oboth": "<b>bold <i>both</i></b>",
        "&oital &6gold": '<i>ital </i><span style="color:#FFAA00">gold</span>',
        "a \\& b &z": "a &amp; b &amp;z",
        "$(l)x": "$(l)x",
        "&kq": '<span class="scrambled">q</span>',
        "&r&r": "",
    },
    "book": {
        "$(l)Stats$()$(li)x": '<b>Stats</b><span class="bullet"></span>x',
        "$(l:a/b)link$(/l) end": '<span class="link">link</span> end',
        "$(/l)x$(unknown)y": "xy",
        "a$(br)b$(br2)c": "a<br>b<br><br>c",
        "$(#00ff00)g": '<span style="color:#00ff00">g</span>',
        "&6 :coin: §5p§r": '&amp;6 <span class="coin"></span> <span style="color:#AA00AA">p</span>',
        "<script>": "&lt;script&gt;",
    },
}


def test_render(spark):
    for dialect, cases in CASES.items():
        assert values(spark, render(F.col("a"), dialect), list(cases)) == list(cases.values())
    assert values(spark, render(F.lit(None).cast("string")), ["x"]) == [""]
