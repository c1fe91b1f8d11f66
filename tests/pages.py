"""Invented dictionary pages."""

FULL = """<html><head><style>x{}</style></head><body><div class="artikel">
<div class="definitionBoxTop"><span class="match">blik2</span><span class="tekstmedium">substantiv</span></div>
<div><span class="stempel">Bøjning</span> <span class="tekstmedium">-ket, -ke , , blikkene, -abcdefg, blik2</span></div>
<div id="id-udt"><span class="tekstmedium"><span class="diskret">normalt</span> <span class="lydskrift">[blig]<a href="/m/1.mp3">l</a></span>
<span class="lydskrift">[bleg]</span><span class="diskret">sjældent</span> <i>x</i><span class="lydskrift">[blik]<a href="/m/2.wav">l</a></span></span></div>
<div><span class="stempel">Oprindelse</span><span class="tekstmedium">fra <a href="#">gammel</a> , via <span class="ordform">ny</span><span class="dividerDot">.</span> senere <b>andet</b> hale</span></div>
<div id="content-betydninger">
<div class="definitionNumber">1</div><p>mellem</p><div class="definitionIndent"><div class="definitionBox" id="betydning-1"><span class="definition">et <b>kort</b> kig</span></div>
<div class="definitionBox grammatik"><span class="stempel">G</span><span class="inlineList">x <i>y</i></span></div>
<div class="definitionBox onym"><a>kig3</a><a>...vis mere</a><a>12</a></div><div class="definitionBox rel-begreber"><a>syn</a></div>
<div class="citat-box"><span class="citat">han så <i>op</i></span><span class="kilde">avis</span></div><div class="citat-box"><span class="citat">intet</span></div></div>
<div class="definitionNumber">2</div><div class="definitionIndent"><div class="definitionBox grammatik">kun  flertal</div></div>
<div class="definitionNumber">3</div></div>
<div id="content-faste-udtryk">
<div id="udtryk-1"><span class="match">på et blik</span></div>
<div class="definitionIndent"><div class="definitionBox" id="udtryk-1-betydning-1">straks</div><div class="definitionBox onym"><a>nu</a></div><div class="definitionBox rel-begreber"><a>tid</a></div>
<div class="definitionBox grammatik">fast</div><div class="definitionBox"><span class="stempel">SPROGBRUG</span><span class="tekstnormal">uformelt</span></div><div class="definitionBox"><span class="stempel">SPROGBRUG</span></div>
<div class="definitionBox"><div class="citat-box"><span class="citat">a b</span></div></div><p><span><div class="definitionBox">dyb</div></span></p></div>
<div id="udtryk-2"><span class="match">kaste et blik</span></div><div class="definitionIndent"><div class="definitionBox" id="udtryk-1-betydning-9">andet</div></div>
<div id="udtryk-3">uden</div></div>
<div id="content-orddannelser"><div class="definitionBox"><span class="stempel">Afledninger</span><span class="inlineList"><a>blikke</a>, <a>blikkelig</a> adj. <b>x</b><a>z</a></span></div>
<div class="definitionBox"><span class="stempel">Øvrige</span></div><div class="definitionBox"><span class="stempel">Afledninger</span><span class="inlineList"><a>sidst</a></span></div></div>
</div></body></html>"""

BROKEN = '<div class="artikel"><div class="definitionBoxTop"></div></div>'
NO_ARTICLE = "<p>intet</p>"
SEARCH = '<div class="searchResultBox"><a href="/q?select=ord,1&x=1">1</a><a href="http://s/q?select=ord%2C2">2</a><a href="/q?select=ord,1&x=1">1</a><a href="/q?select=andet,1">3</a><a href="/q">4</a><a>5</a></div>'
WORD_LIST = '<ol><li><a>no</a></li></ol><h3 id="Danish">D</h3><p>x</p><ol><li><a> Og </a><a>2</a></li><li>uden</li><li><a>i</a></li><li><a>og</a></li></ol><ol><li><a>late</a></li></ol>'
