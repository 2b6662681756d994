"""Small feed payloads of each kind."""

RSS = """<rss version="2.0"><channel><item><title> First </title><link>http://a/1</link><description>&lt;p&gt;Hi &lt;b&gt;there&lt;/b&gt;&lt;/p&gt;</description><pubDate>Mon</pubDate></item>
<item><title>Second</title><link>http://a/2</link><description>neural nets</description></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>One</title><link href="http://b/1"/><summary>s</summary><updated>2024</updated></entry>
<entry><title>One</title><link href="http://b/2"/></entry><entry><title>  </title></entry></feed>"""
PAPERS = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://p/1</id><title>A
  paper</title><summary>On  neural
 things</summary><published>2024</published><author><name>X</name></author><author><name>Y</name></author><link href="http://p/1.html" type="text/html"/><category term="cs.AI"/><category term="cs.CL"/></entry></feed>"""
