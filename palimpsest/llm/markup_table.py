"""The labelled table that the decision trees of ``markup`` are trained on, and the surroundings its rows are set in."""

#: An ordinary sentence, for blocks of many words.
PROSE = "We look at each letter in turn and answer it as soon as the papers are here. "

#: Lines of such sentences.
LINES = f"{PROSE}\n" * 60

#: What stands before and behind a labelled row: paragraphs, nothing, a heading above or text below, links.
FILLERS = (
    ("<p>Some words before it all, which are a sentence.</p>", "<p>Some words behind it all, which are another.</p>"),
    ("", ""),
    ("<h2>Rates of this year</h2>", "<p>Some words behind it all, which are another.</p>"),
    ("<p>Some words before it all, which are a sentence.</p>", ""),
    ("<p><a href='x'>The page before</a></p>", "<p><a href='y'>The page behind</a></p>"),
)

# HTML as a block may stand in a value, and the kind of markup it holds.
LABELLED = (
    ("<p>The **new limit** holds from Monday.</p>", "markdown"),
    ("<p>Read [our terms](https://example.org/terms) first.</p>", "markdown"),
    ("<p>![a stamp](img/stamp.png) Send the form.</p>", "markdown"),
    ("## How to apply\n", "markdown"),
    ("# Contact\n\nWrite to us.", "markdown"),
    ("```\nselect 1\n```", "markdown"),
    ("```python\nprint(1)\n```", "markdown"),
    ("<div>| Year | Rate |\n|---|---|\n| 1 | 2 % |</div>", "markdown"),
    ("<p>Set `mode-7` in the form.</p>", "markdown"),
    ("<p>This is __important__ for you.</p>", "markdown"),
    ("- bring a form\n- sign it\n- send it", "markdown"),
    ("* first\n* second", "markdown"),
    ("<p>Keep the *whole* letter.</p>", "markdown"),
    ("1. open the page\n2. press the button\n3. wait\n", "markdown"),
    ("<p>It is ~~gone~~ still there.</p>", "markdown"),
    ("> quoted words\n> more words\n\n- a\n- b", "markdown"),
    ("<p>See [[Opening hours]] and [[Fees|the fees]].</p>", "wiki"),
    ("<p>The '''yearly''' fee.</p>", "wiki"),
    ("== History ==\n", "wiki"),
    ("=== Older rates ===", "wiki"),
    ("<div>{{Stub}}</div>", "wiki"),
    ("{{Box|title=Note|text=Closed on Sunday}}", "wiki"),
    ('{| class="table"\n! A !! B\n|-\n| 1 || 2\n|}', "wiki"),
    ("<p>[https://example.org/a The old page] is gone.</p>", "wiki"),
    ("<p>[http://example.org/a Archive] ''as of May''</p>", "wiki"),
    ("<p>See [[Help]].</p>", "wiki"),
    ("<p>The \\textbf{rate} is \\emph{low}.</p>", "latex"),
    ("\\section{Rates}\n", "latex"),
    ("\\begin{itemize}\n\\item one\n\\item two\n\\end{itemize}", "latex"),
    ("<p>Pay $x = a \\cdot b$ now.</p>", "latex"),
    ("<p>With $a_1 + b_2$ in all.</p>", "latex"),
    ("<p>\\[ \\int_0^1 x \\]</p>", "latex"),
    ("<li>Sum: \\(a + b\\)</li>", "latex"),
    ("<p>$$ x^2 $$</p>", "latex"),
    ("<p>\\frac{1}{2} of it</p>", "latex"),
    ("<p>&lt;b&gt;Note&lt;/b&gt; the date.</p>", "escaped_html"),
    ("<p>One&lt;br/&gt;two</p>", "escaped_html"),
    ("<p>&amp;lt;i&amp;gt;now&amp;lt;/i&amp;gt;</p>", "escaped_html"),
    ("&lt;ol&gt;&lt;li&gt;a form&lt;/li&gt;&lt;/ol&gt;", "escaped_html"),
    ('<p>&lt;a href="x"&gt;here&lt;/a&gt;</p>', "escaped_html"),
    ("<p>&amp;amp;lt;p&amp;amp;gt;Hello&amp;amp;lt;/p&amp;amp;gt;</p>", "escaped_html"),
    ("<p>Call us before noon, please.</p>", ""),
    ("<p>If a &lt; 5 and b &gt; 7, see [3].</p>", ""),
    ("<p>From $4 to $9 each.</p>", ""),
    ("<p>* Terms apply.</p>", ""),
    ("<p>3 * 4 * 5 is sixty.</p>", ""),
    ("<p>The name user_id_key has ticket #77.</p>", ""),
    ("<p>Saved in D:\\data\\in\\file-1.</p>", ""),
    ("<p>Keep [[IMM_012]] and [[P3]] here.</p>", ""),
    ("<p>Type <code>**x**</code> or <code>[[y]]</code>.</p>", ""),
    ("<pre><code># not a heading\n- no list</code></pre>", ""),
    ("<p>R&amp;D and A&amp;B</p>", ""),
    ("<li>1) 2) 3)</li>", ""),
    ("<p>0012|44.5;0013|45.1;0014|46.2;</p>", ""),
    ("<p>See note [1] and note [2].</p>", ""),
    ("<p>- - -</p>", ""),
    ("<p>It costs $5 - or £6 - a day.</p>", ""),
    ("<p>x = 5, y = 6 and 7 > 5</p>", ""),
    ("<p>a_b and c_d_e are fields.</p>", ""),
    ("<p>Rock 'n' roll isn't the '60s' only.</p>", ""),
    ("<p>—</p>", ""),
    ("<p>A &lt;- B and C -&gt; D</p>", ""),
    ("<p>Fee* and charge** as noted.</p>", ""),
    ("<p>Write to {name} at {address}.</p>", ""),
    ("<h2>Fees # 4</h2>", ""),
    ("<p><a href='x'>Fees</a> <a href='y'>Cards</a></p>", ""),
    ("<p>- only one line with a dash</p>", ""),
    ("<p>1. only one</p>", ""),
    ("<p>&amp;nbsp; is a blank</p>", ""),
    # long blocks with one mark
    (f"<p>{PROSE * 12} It is **due**. {PROSE * 12}</p>", "markdown"),
    (f"<p>{PROSE * 6} Press `go`. {PROSE * 6}</p>", "markdown"),
    (f"<p>{PROSE * 12} See [[Fees]]. {PROSE * 12}</p>", "wiki"),
    (f"<p>{PROSE * 12} It is \\emph{{due}}. {PROSE * 12}</p>", "latex"),
    (f"<p>{PROSE * 12} It is $x_1 + 2$. {PROSE * 12}</p>", "latex"),
    (f"<p>{PROSE * 12} It is &lt;b&gt;due&lt;/b&gt;. {PROSE * 12}</p>", "escaped_html"),
    (f"{PROSE * 4}\n## Next\n{PROSE * 4}\n{PROSE}\n{PROSE}\n{PROSE}", "markdown"),
    (f"{PROSE * 4}\n== Next ==\n{PROSE * 4}\n{PROSE}\n{PROSE}\n{PROSE}", "wiki"),
    # blocks of many lines with one mark
    (f"{LINES}## Next\n{LINES}", "markdown"),
    (f"{LINES}```\ngo\n```\n{LINES}", "markdown"),
    (f"{LINES}| a | b |\n|---|---|\n{LINES}", "markdown"),
    (f"{LINES}== Next ==\n{LINES}", "wiki"),
    (f"{LINES}{{|\n| a || b\n|}}\n{LINES}", "wiki"),
    (LINES, ""),
    (f"{LINES}* Terms apply.\n{LINES}", ""),
    # several kinds of one markup
    ("<div># Rates\n\n- a\n- b</div>", "markdown"),
    ("<li>![front](img/front.png) Keep the *first* page.</li>", "markdown"),
    ("<p>Keep the _first_ page.</p>", "markdown"),
    ("<p>The ''newer'' rate and the '''older''' one.</p>", "wiki"),
    ("<div>* [[Cards]]\n* [[Loans|loans]]</div>", "wiki"),
    # menus of links that begin with marks
    ("<p>* <a href='a'>Home page</a><br>* <a href='b'>All fees</a><br>* <a href='c'>Cards</a></p>", ""),
    ("<div>- <a href='a'>Home page</a><br>- <a href='b'>All fees</a></div>", ""),
    ("<p>1. <a href='a'>Home page</a><br>2. <a href='b'>All fees</a><br>3. <a href='c'>Our cards</a></p>", ""),
    ("<div>+ <a href='a'>Older letters</a><br>+ <a href='b'>Newer letters</a></div>", ""),
    ("<p>* <a href='a'>Home page of the bank</a><br>* <a href='b'>All fees at a glance</a><br>* <a href='c'>Cards and loans</a><br>* <a href='d'>Where we are</a></p>", ""),
    # number signs over columns
    ("<table><tr><th># Items</th><td>4</td></tr></table>", ""),
    ("<table><tr><td># 12</td><td>EUR 4</td></tr><tr><td># 13</td><td>EUR 5</td></tr></table>", ""),
    ("<table><tr><td>Ref</td><th># Pages</th><td>2</td></tr></table>", ""),
    # long prose that names a field or footnote
    (f"<p>{PROSE * 3} The field _ref_ stays. {PROSE * 3}</p>", ""),
    (f"<p>{PROSE * 2} The rate *see below* holds. {PROSE * 3}</p>", ""),
    (f"<p>{PROSE * 4} Leave _code_ empty. {PROSE * 2}</p>", ""),
    # more of each group of marks
    ("- Bring the signed form with you\n- Bring a photo of yourself that is new\n- Ask at the desk for a receipt\n", "markdown"),
    ("<div>* Open the page of your account and choose it\n* Press the button below the list of cards</div>", "markdown"),
    ("Please bring:\n- a form that is signed\n- a photo of the last year\n- the letter we sent to you\n", "markdown"),
    ("1. Open the page of your account\n2. Choose the card that is lost\n3. Press the button\n4. Wait for our letter\n", "markdown"),
    ("<div>- one\n- two\n- three\n- four\n- five of them all together here</div>", "markdown"),
    ("# Contact\n", "markdown"),
    ("# Terms of the new card\n", "markdown"),
    ("<div># How long it takes</div>", "markdown"),
    ("<p>Please keep the *original* letter at home for some years.</p>", "markdown"),
    ("<p>For the time being you may _not_ use the older form, as it was replaced in May.</p>", "markdown"),
    ("<table><tr><td># Cards</td><td>2</td><td># Loans</td><td>1</td></tr></table>", ""),
    ("<table><tr><th># of days</th><td>12</td></tr><tr><th># of weeks</th><td>2</td></tr></table>", ""),
    ("## Fees\n", "markdown"),
    ("### Next steps\n", "markdown"),
    ("#### Who may apply\n", "markdown"),
    ("<div># Opening hours of this office\nMonday to Friday.</div>", "markdown"),
    ("- a form\n- a photo\n", "markdown"),
    ("<div>+ bring it\n+ send it\n+ keep a copy</div>", "markdown"),
    ("1. sign it\n2. send it\n", "markdown"),
    ("* the card\n* the letter\n* the code\n", "markdown"),
    ("~~~\nls -l\n~~~", "markdown"),
    ("<div>| Card | Fee |\n| --- | ---: |\n| Gold | 9 |\n| Blue | 0 |</div>", "markdown"),
    ("- [ ] sign\n- [x] send", "markdown"),
    ("<p>The *small* print.</p>", "markdown"),
    ("<p>Do _not_ fold it.</p>", "markdown"),
    ("<p>Press *send* and *close* now.</p>", "markdown"),
    ("<li>Call [the desk](tel:123) first.</li>", "markdown"),
    ("== Fees ==\n", "wiki"),
    ("=== Who may apply ===\n", "wiki"),
    ("<div>== Notes ==\nNone so far.</div>", "wiki"),
    ("{|\n| a || b\n|}", "wiki"),
    ('<div>{| border="1"\n|-\n! Card !! Fee\n|-\n| Gold || 9\n|}</div>', "wiki"),
    ("<p>The ''small'' print of this page.</p>", "wiki"),
    ("<p>Read ''all'' of it.</p>", "wiki"),
    ("<p>It is ''not'' due.</p>", "wiki"),
    ("<p>It was ''never'' sent to us.</p>", "wiki"),
    ("# [[First]]\n# [[Second]]", "wiki"),
    ("<p>{{Outdated|since=May}} Fees rise.</p>", "wiki"),
    ("<p>\\emph{Note:} it is due.</p>", "latex"),
    ("\\subsection{Who may apply}", "latex"),
    ("\\begin{enumerate}\n\\item sign\n\\end{enumerate}", "latex"),
    ("<p>\\item a form</p>", "latex"),
    ("<div>\\item a form\n\\item a photo</div>", "latex"),
    ("<p>It is 3 \\times 4 \\ldots in all.</p>", "latex"),
    ("<p>One \\par two \\newline three.</p>", "latex"),
    ("<p>\\[ a = b \\]</p>", "latex"),
    ("<p>So \\(x\\) grows.</p>", "latex"),
    ("<p>Here $r^n$ is the rate.</p>", "latex"),
    ("<p>&lt;em&gt;Note&lt;/em&gt;</p>", "escaped_html"),
    ("<p>First line&lt;br&gt;second line of it</p>", "escaped_html"),
    ("<p>&lt;!-- checked --&gt; Fine.</p>", "escaped_html"),
    ("<div>&lt;table&gt;&lt;tr&gt;&lt;td&gt;1&lt;/td&gt;&lt;/tr&gt;&lt;/table&gt;</div>", "escaped_html"),
    ("<p>&amp;amp;amp;lt;b&amp;amp;amp;gt;now&amp;amp;amp;lt;/b&amp;amp;amp;gt;</p>", "escaped_html"),
    ("<p>** Only for members.</p>", ""),
    ("<p>*** Until further notice.</p>", ""),
    ("<p>+ postage</p>", ""),
    ("<p>2. Second floor</p>", ""),
    ("<p>P&amp;amp;L of Q&amp;amp;A</p>", ""),
    ("<p>See /srv/data/in and C:\\temp\\par.txt</p>", ""),
    ("<p>From $5 to $10_000 at most</p>", ""),
    ("<p>if a &lt; b then c</p>", ""),
    ("<p>[1] First note [2] Second note</p>", ""),
    ("<p>; or : or = or == signs</p>", ""),
    # lines without marks
    ("<p>Main Street 5<br>Oldtown<br>Open from 9 to 5</p>", ""),
    ("<div>First line of it\nsecond line of it\n\nthird line of it</div>", ""),
    (f"{PROSE}\n{PROSE}\n{PROSE}", ""),
    (f"{PROSE}\n\n{PROSE}\n\n{PROSE}\n{PROSE}\n\n{PROSE}\n{PROSE}", ""),
    (f"<div>\n    {PROSE}\n    {PROSE}\n    Yours\n    The desk\n</div>", ""),
    ("<p>A: yes<br>B: no</p>", ""),
    ("<p>1|44;2|45;\n3|46;4|47;</p>", ""),
    ("<p>Rates of 2020\nRates of 2021\nRates of 2022\nRates of 2023</p>", ""),
    ("<div>Fees:\nEUR 5 (cards)\nEUR 6 (loans), $7 abroad\n(see note 3)</div>", ""),
    ("<p>The fee is EUR 4.*<br>* Terms apply to this fee.</p>", ""),
    ("<p>The fee is EUR 4.*\nThe other is EUR 5.**\n* From May on.\nAsk us.</p>", ""),
    ("<p>Keep [[P1]] here\nand [[IMM_002]] there,\nso that user_id_key stays.</p>", ""),
    ("<div>Dear all,\n\nnumbers a &lt; 5 and b &gt; 7 hold.\n\nYours</div>", ""),
    # a quotation of another letter in front of an answer
    ("<p>> 5 years</p>", ""),
    ("<p>&gt; 30 days late</p>", ""),
)
