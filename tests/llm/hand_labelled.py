"""Pages written and labelled by hand, in manners of marking up that the composed
training pages do not use. A line that starts with + holds one block of the
article, a line with - holds none; the marks are not part of the page."""

PAGES = {
    "news, div soup": """
- <html><head><title>Harbour reopens | Coast Daily</title><style>.x{}</style></head><body><div id="top"><div class="logo"><a href="/">Coast Daily</a></div>
- <div class="topnav"><a href="/w">World</a> <a href="/s">Sport</a> <a href="/l">Local</a></div></div><div class="wrap"><div class="col-main"><div class="story">
+ <h1 class="hl">Harbour reopens after a winter of repairs</h1>
- <div class="share"><a href="#">Share</a> <a href="#">Tweet</a></div>
+ <div class="para">The old harbour opened again on Monday, four months after a storm broke the outer wall and sank eleven boats.</div>
+ <div class="para">&ldquo;We did not expect to be back before the summer,&rdquo; said the harbour master, who has worked there for thirty years.</div>
- <div class="promo">Subscribe now and get three months for one pound</div>
+ <div class="para">The repairs cost 2.4 million, most of it paid by the county. A second wall is planned for next year.</div>
- </div><div class="more"><h3>More stories</h3><ul><li><a href="/a">Ferry prices to rise</a></li><li><a href="/b">Market moves to the square</a></li></ul></div></div>
- <div class="col-right"><div class="widget"><h4>Weather</h4><p>12 degrees, rain</p></div></div></div><div id="bottom">Copyright Coast Daily. <a href="/t">Terms</a></div></body></html>""",
    "blog with reader comments": """
- <body class="blog"><header class="site-header"><a href="/">A slow kitchen</a></header><div id="content"><div class="hentry">
+ <h2 class="title">Why I stopped weighing flour</h2>
- <p class="meta">Posted on 3 March by Ana in <a href="/bread">Bread</a></p>
+ <p>For years I weighed everything to the gram. Then the scale broke, and the bread got better.</p>
+ <p>That is not because cups are more exact. It is because I began to look at the dough, and to <em>feel</em> how wet it was.</p>
+ <blockquote>Dough does not read recipes, my grandmother used to say.</blockquote>
+ <p>So here is what I do now: start with less water than you think, and add it by the spoon.</p>
- </div><div id="respond"><h3>2 thoughts on this post</h3><ol class="commentlist"><li class="comment"><p>Great post, I will try this at the weekend with rye.</p></li>
- <li class="comment"><p>My scale is my best friend, sorry, I do not agree at all.</p></li></ol><form><label>Leave a reply</label><textarea></textarea><button>Send</button></form></div></div>
- <aside id="secondary"><h3>Archives</h3><ul><li><a href="/1">January</a></li><li><a href="/2">February</a></li></ul></aside><footer>Powered by words</footer></body>""",
    "documentation": """
- <div class="navbar"><a>Home</a><a>Guide</a><a>Reference</a></div><div class="toc"><ul><li><a href="#i">Install</a></li><li><a href="#u">Use</a></li></ul></div><main role="main">
+ <h1>Reading files</h1>
+ <p>The reader takes a path and returns rows. It never loads the whole file: rows are produced as you ask for them.</p>
+ <h2 id="u">Use</h2>
+ <pre>rows = open_rows("data.csv")</pre>
+ <p>Every row is a tuple. Missing cells are returned as <code>None</code>, and a cell that cannot be read raises an error.</p>
+ <ul><li>Quoted cells may contain line breaks.</li>
+ <li>Comment lines are skipped if you ask for it.</li></ul>
- </main><div class="pager"><a href="p">Previous</a><a href="n">Next</a></div><footer><p>Last built in May. <a>Edit this page</a></p></footer>""",
    "encyclopedia": """
- <div id="mw-head"><a>Read</a><a>Edit</a><a>View history</a></div><div id="bodyContent" class="mw-body">
+ <h1>Lime kiln</h1>
+ <p>A <b>lime kiln</b> is a kiln that burns limestone to make quicklime. The reaction takes place at about 900 &deg;C.</p>
+ <h2>History</h2>
+ <p>Kilns were built wherever stone, fuel and a road or river came together. Many were worked by one family for generations.</p>
+ <p>In the nineteenth century they grew larger, and burned without stopping for months at a time.</p>
- </div><div id="mw-panel"><h3>Navigation</h3><ul><li><a>Main page</a></li><li><a>Random article</a></li></ul></div><div id="footer"><ul><li>Text is available under a licence.</li><li><a>Privacy policy</a></li></ul></div>""",
    "table layout": """
- <table width="100%"><tr><td colspan="2"><font size="5">Village Choir</font></td></tr><tr><td width="150"><a href="1.html">Home</a><br><a href="2.html">Concerts</a><br><a href="3.html">Contact</a></td><td>
+ <p>Our spring concert takes place on the second Sunday of May, in the church hall, at four in the afternoon.</p>
+ <p>We will sing three old songs from the valley, and a new piece that our director wrote for the occasion.</p>
+ <p>Tickets are sold at the door. Children come in free, and there will be tea and cake in the break.</p>
- </td></tr><tr><td colspan="2"><font size="1">Webmaster: the treasurer. Best viewed with a large screen.</font></td></tr></table>""",
    "german, modern markup": """
- <nav aria-label="Haupt"><ul><li><a>Startseite</a></li><li><a>Politik</a></li></ul></nav><div class="cookie-banner"><p>Wir verwenden Cookies.</p><button>Zustimmen</button></div><main><article class="artikel">
+ <h1>Neue Brücke über die Ahr eröffnet</h1>
- <div class="author-line">Von Petra Klein, 4. Juni</div>
+ <p>Nach zwei Jahren Bauzeit ist die neue Brücke am Samstag für Fußgänger und Radfahrer freigegeben worden.</p>
+ <p>Die alte Brücke war bei der Flut zerstört worden. Viele Bewohner mussten seither einen Umweg von acht Kilometern fahren.</p>
- <div class="newsletter-box"><p>Jetzt Newsletter bestellen!</p><input><button>Los</button></div>
+ <p>Der Bürgermeister dankte den Helfern und kündigte an, dass im Herbst auch die Uferwege fertig werden.</p>
- </article><section class="related-articles"><h2>Mehr zum Thema</h2><a>Straße bleibt gesperrt</a></section></main><footer><a>Impressum</a><a>Datenschutz</a></footer>""",
    "only menus": """
- <nav><a href="/">Home</a><a href="/shop">Shop</a></nav><form action="/login"><label>Name</label><input><label>Password</label><input><button>Log in</button></form><footer><a>Help</a> <a>Terms of use</a></footer>""",
}
