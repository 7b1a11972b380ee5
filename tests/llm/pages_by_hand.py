"""Pages written by hand, in the manner of several kinds of sites, with class names that the training pages don't have; and their main text."""

NEWS = (
    """<!doctype html>
<html lang="en"><head><meta charset="utf-8"><title>Harbour bridge reopens | The Ferry Post</title>
<link rel="stylesheet" href="/x.css"><script>window.dl=[{"a":"<p>no</p>"}];</script></head>
<body class="tpl-17">
<div class="c-skip"><a href="#m">Skip to content</a></div>
<header class="c-mast"><div class="c-mast__in"><a class="c-logo" href="/">The Ferry Post</a>
<nav aria-label="Sections"><ul class="c-sec"><li><a href="/w">World</a></li><li><a href="/c">City</a></li><li><a href="/m">Money</a></li><li><a href="/s">Sport</a></li></ul></nav></div></header>
<main id="m" class="l-grid"><article class="c-piece">
<h1 class="c-piece__hd">Harbour bridge reopens after nine months of repairs</h1>
<p class="c-piece__st">Drivers crossed the old bridge again on Monday, two weeks earlier than the city had planned.</p>
<p>The bridge was closed last autumn when divers found cracks in two of its piers. Since then, some forty thousand cars a day took the tunnel, where queues of half an hour were common in the morning.</p>
<p>&ldquo;We replaced far more steel than we thought we would,&rdquo; said the engineer in charge, who asked for patience while the last lanes are painted. The work cost about 31&nbsp;million, a tenth less than was set aside.</p>
<h2>What comes next</h2>
<p>Ferries that were added for the time of the repairs will run until the end of the month. After that, the council wants to decide whether one of the lines can stay, as many passengers have asked for it.</p>
</article>
<div class="c-rail"><h3>Most read</h3><ol><li><a href="/1">Ten beaches for a short day</a></li><li><a href="/2">Rents rise again</a></li><li><a href="/3">Who won the regatta</a></li></ol></div></main>
<footer class="c-base"><p>&copy; The Ferry Post. <a href="/t">Terms</a> <a href="/p">Privacy</a> <a href="/k">Contact</a></p></footer></body></html>""",
    """Harbour bridge reopens after nine months of repairs
Drivers crossed the old bridge again on Monday, two weeks earlier than the city had planned.
The bridge was closed last autumn when divers found cracks in two of its piers. Since then, some forty thousand cars a day took the tunnel, where queues of half an hour were common in the morning.
“We replaced far more steel than we thought we would,” said the engineer in charge, who asked for patience while the last lanes are painted. The work cost about 31 million, a tenth less than was set aside.
What comes next
Ferries that were added for the time of the repairs will run until the end of the month. After that, the council wants to decide whether one of the lines can stay, as many passengers have asked for it.""",
)

BLOG = (
    """<html><head><title>Sourdough in a cold kitchen</title></head><body><div class="outer"><div class="top-strip"><a href="/">Crumb &amp; Crust</a> <a href="/about">About</a> <a href="/recipes">Recipes</a></div>
<div class="hentry"><h1>Sourdough in a cold kitchen</h1><div class="when">12 March</div>
<div class="e-content"><p>My kitchen is never above sixteen degrees in winter, and for years I blamed my starter for flat loaves. It was not the starter, it was the clock: in the cold, everything takes about twice as long.</p>
<p>So now I mix the dough in the evening, fold it four times before bed, and let it stand until noon. The long wait gives it more taste as well, and the crust blisters nicely.</p>
<blockquote><p>Watch the dough, not the clock, as my neighbour says.</p></blockquote>
<ul><li>500 g of flour, a third of it whole grain</li><li>350 g of water</li><li>100 g of starter and 10 g of salt</li></ul></div></div>
<div class="wp-block-talk" id="respond"><h3>3 thoughts</h3><ol><li><cite>Ana</cite><p>Thanks, this worked for me too!</p></li><li><cite>Bo</cite><p>Have you tried a warm box?</p></li></ol><form action="/c"><label>Name</label><input name="n"><textarea name="t"></textarea><button>Send</button></form></div>
<div class="btm">Powered by flour. <a href="/rss">RSS</a></div></div></body></html>""",
    """Sourdough in a cold kitchen
My kitchen is never above sixteen degrees in winter, and for years I blamed my starter for flat loaves. It was not the starter, it was the clock: in the cold, everything takes about twice as long.
So now I mix the dough in the evening, fold it four times before bed, and let it stand until noon. The long wait gives it more taste as well, and the crust blisters nicely.
Watch the dough, not the clock, as my neighbour says.
500 g of flour, a third of it whole grain
350 g of water
100 g of starter and 10 g of salt""",
)

MANUAL = (
    """<!DOCTYPE html><html><body><div id="doc-shell"><div class="toc-col"><p class="cap">On this page</p><ul><li><a href="#a">Install</a></li><li><a href="#b">Configure</a></li><li><a href="#c">Run</a></li></ul></div>
<div role="main" class="md"><h1 id="a">Install the pump controller</h1><p>Before you begin, switch off the supply and wait until both lamps are dark. The controller holds a charge for up to a minute.</p>
<pre>pumpctl init --rate 40
pumpctl status</pre><p>If the second lamp blinks, the sensor cable is loose. Push it in until it clicks, then start again from the first step.</p>
<table><tr><th>Lamp</th><th>Meaning</th></tr><tr><td>steady</td><td>ready to pump</td></tr><tr><td>blinking</td><td>cable is loose</td></tr></table></div>
<div class="fb"><span>Was this page helpful?</span> <button>Yes</button> <button>No</button></div></div>
<div class="legalese"><a href="/i">Imprint</a> | <a href="/d">Data policy</a> | <a href="/l">Licences</a></div></body></html>""",
    """Install the pump controller
Before you begin, switch off the supply and wait until both lamps are dark. The controller holds a charge for up to a minute.
pumpctl init --rate 40 pumpctl status
If the second lamp blinks, the sensor cable is loose. Push it in until it clicks, then start again from the first step.
Lamp
Meaning
steady
ready to pump
blinking
cable is loose""",
)

OLD = (
    """<HTML><BODY BGCOLOR=white><TABLE WIDTH=100%><TR><TD COLSPAN=2><FONT SIZE=5><B>Valley Hiking Club</B></FONT></TD></TR>
<TR><TD WIDTH=120 VALIGN=top><A HREF=index.html>Home</A><BR><A HREF=trips.html>Trips</A><BR><A HREF=join.html>Join</A><BR><A HREF=pics.html>Pictures</A></TD>
<TD VALIGN=top><H1>The ridge walk in autumn</H1><P>We met at seven at the mill, eleven of us and two dogs, and climbed through fog for the first two hours. Above the tree line the sun came out and the whole valley lay below us like a white lake.
<P>The way down is steep and was wet, so we took our time. At the hut there was soup, and the last bus waited for us, which was kind of the driver.
<P>Next month we shall walk along the river instead, which is easier on the knees.</TD></TR>
<TR><TD COLSPAN=2 ALIGN=center><A HREF=mailto:x@example.com>Webmaster</A> | <A HREF=guest.html>Guestbook</A> | Last changed in October</TD></TR></TABLE></BODY></HTML>""",
    """The ridge walk in autumn
We met at seven at the mill, eleven of us and two dogs, and climbed through fog for the first two hours. Above the tree line the sun came out and the whole valley lay below us like a white lake.
The way down is steep and was wet, so we took our time. At the hut there was soup, and the last bus waited for us, which was kind of the driver.
Next month we shall walk along the river instead, which is easier on the knees.""",
)

MAGAZINE = (
    """<html><body><div class="sc-1a2b3c"><div class="sc-9f8e"><a href="/">Lumen</a><a href="/art">Art</a><a href="/film">Film</a><a href="/books">Books</a><a href="/log">Sign in</a></div>
<div class="sc-77aa"><p>We use small files to make this site work. <a href="/ok">Fine</a></p></div>
<section class="sc-40d1"><h1>The painter who only used blue</h1><p>For the last twenty years of her life she bought one colour only, in tins of five litres, and mixed it with ash, chalk and milk. Visitors to the studio remember the smell more than the pictures.</p>
<div class="sc-b00b"><p>Read on without limits for one coin a week</p><a href="/buy">Subscribe now</a></div>
<p>What is left of the work fills two rooms in the town where she was born. The light there is poor, the guards say, but it was poor in her kitchen as well, and she never wanted a lamp.</p>
<p>The show is open until the end of June; children pay nothing.</p></section>
<div class="sc-c0de"><h4>You might also like</h4><a href="/x1">Nine chairs by one man</a><a href="/x2">Films without an end</a><a href="/x3">Letters from a lighthouse</a></div></div></body></html>""",
    """The painter who only used blue
For the last twenty years of her life she bought one colour only, in tins of five litres, and mixed it with ash, chalk and milk. Visitors to the studio remember the smell more than the pictures.
What is left of the work fills two rooms in the town where she was born. The light there is poor, the guards say, but it was poor in her kitchen as well, and she never wanted a lamp.
The show is open until the end of June; children pay nothing.""",
)

ALL = {"news": NEWS, "blog": BLOG, "manual": MANUAL, "old": OLD, "magazine": MAGAZINE}


def agreement(got: str, want: str) -> float:
    """F1 of the words, repeats counted."""
    from collections import Counter

    a, b = Counter(got.split()), Counter(want.split())
    shared = sum((a & b).values())
    return 2 * shared / max(sum(a.values()) + sum(b.values()), 1)
