"""A small labelled table of urls, the default training table of the URL filter: one url a line, no host in both lists.

The hosts to block are invented in the manner of junk mail and link farms; those to allow are invented or well-known public sites.
"""

# Labelled training rows.
BLOCK = """
http://www.buy-cheap-meds-online.biz/order/now
http://discount-pharmacy-pills.info/no-prescription
https://canadian-pharm-direct.top/viagra-cialis
http://generic-tablets24.shop/sale/cheap
http://rx-pills-store.net/buy/tramadol
http://weightloss-miracle-diet.site/free-trial
https://keto-burn-pills.club/offer.html
http://best-online-casino-bonus.win/free-spins
http://royal-slots-jackpot.bet/register
https://www.poker-big-win.casino/bonus-code
http://sports-betting-tips247.info/win
http://lucky-roulette-club.xyz/spin?aff=12
https://bitcoin-doubler-profit.top/invest
http://crypto-earn-fast.click/signup
http://forex-robot-millions.biz/join-now
http://make-money-from-home-today.info/easy-cash
https://quick-payday-loans-approved.com.co/apply
http://instant-cash-advance.loan/bad-credit
http://debt-relief-now-offer.us/free-quote
http://hot-singles-near-you.date/chat
https://www.adult-webcam-girls.xxx/live
http://free-porn-tube-videos.sex/watch/123
http://sexy-dating-hookup.club/profile
http://nude-celeb-leaks.top/gallery
https://erotic-cams-free.live/room/8
http://warez-full-crack-download.ru.net/keygen
http://free-serial-keys.cc/windows-activator
https://torrent-movies-hd-free.to/download
http://cracked-apk-mods.site/unlimited-coins
http://software-nulled-scripts.in/themes
http://replica-watches-outlet.cn.com/rolex
http://cheap-designer-handbags.shop/louis
https://fake-id-documents.top/passport
http://buy-instagram-followers.pro/cheap
http://get-free-likes-fast.xyz/tiktok
http://seo-backlinks-service.info/buy-links
http://link-exchange-farm.biz/directory/add
http://article-spinner-seo.net/cheap-content
https://guaranteed-ranking-seo.top/order
http://spam-comment-poster.org/buy
http://mass-email-sender.cc/bulk-lists
http://bulk-mail-leads.biz/cheap/offer
http://win-free-iphone-prize.click/claim
https://gift-card-generator.fun/free
http://you-won-lottery.info/claim-now
http://survey-rewards-cash.site/start?ref=99
http://congratulations-winner.top/prize/1
http://secure-account-verify.tk/paypal/login
https://bank-login-update.ml/confirm
http://webmail-password-reset.ga/verify-now
http://apple-id-locked.support-center.cf/unlock
http://tax-refund-claim.gq/form
http://download-flash-player-update.pw/setup.exe
http://pc-cleaner-speedup.download/free-scan
https://antivirus-alert-warning.xyz/call-now
http://driver-updater-free.space/install
http://essay-writing-cheap.biz/order-essay
https://buy-term-papers-now.info/discount
http://psychic-reading-free.club/offer
http://penis-enlargement-pills.top/buy-now
http://male-enhancement-offer.site/trial
http://anti-aging-cream-deal.shop/free-bottle
http://cbd-gummies-discount.store/sale
http://vape-juice-cheap-deal.top/buy
http://work-at-home-jobs-fast.info/cash
http://get-rich-quick-secret.win/video
https://mlm-passive-income.club/join
http://binary-options-signal.biz/profit
http://cheap-hosting-coupon.click/deal/99
http://insurance-cheap-quotes.us.com/compare
http://ringtones-free-mobile.mobi/sms
http://horoscope-sms-club.info/subscribe
http://clickbait-shocking-news.buzz/you-wont-believe
http://celebrity-gossip-shock.buzz/click
http://viral-videos-omg.click/watch-now
http://expired-domains-parking.cc/?q=loans
http://domain-for-sale-cheap.top/buy
http://traffic-exchange-hits.info/earn
http://autosurf-bonus.biz/credits
http://xrated-stories-free.site/sex
http://escort-girls-city.club/book
http://mail-order-brides.date/meet
http://steroids-shop-online.biz/buy-cheap
http://weed-seeds-discount.shop/order
http://cheap-flights-deal-spam.click/offer
http://free-credit-report-scam.info/score
http://hacked-accounts-market.cc/buy
http://dumps-cvv-shop.su/cards
http://ddos-booter-cheap.top/plans
http://proxy-lists-free.xyz/socks
"""
ALLOW = """
https://en.wikipedia.org/wiki/Linear_algebra
https://fr.wikibooks.org/wiki/Cuisine
https://www.gutenberg.org/ebooks/2701
https://docs.python.org/3/library/json.html
https://developer.mozilla.org/en-US/docs/Web/HTML
https://spark.apache.org/docs/latest/sql-ref.html
https://www.w3.org/TR/html5/
https://datatracker.ietf.org/doc/html/rfc9110
https://arxiv.org/abs/1706.03762
https://www.nature.com/articles/s41586-020-2649-2
https://www.nasa.gov/missions/
https://www.noaa.gov/weather
https://www.loc.gov/collections/maps/
https://www.bl.uk/manuscripts
https://www.who.int/news-room/fact-sheets
https://europa.eu/european-union/law_en
https://www.bundestag.de/dokumente
https://www.legifrance.gouv.fr/codes/
https://www.boe.es/diario_boe/
https://www.cam.ac.uk/research/news
https://www.ethz.ch/en/studies.html
https://www.uni-heidelberg.de/de/studium
https://www.sorbonne-universite.fr/formation
https://www.ub.edu/web/portal/ca/
https://news.harbourpost.org/2021/05/council-vote
https://www.valleyherald.net/local/school-opens
https://morgenblatt.example-zeitung.de/politik/wahl
https://www.lemarche-quotidien.fr/culture/theatre
https://diario.elpuerto.es/sociedad/ferias
https://www.riverside-library.org/opening-hours
https://museum.oldtown.org/exhibitions/2020
https://archive.countyrecords.net/parish/1841
https://weather.mountainhut.org/forecast/tuesday
https://www.gardenersnotebook.net/roses/pruning
https://blog.breadandbutter.org/sourdough-starter
https://kitchen.grandmas-table.net/soups/lentil
https://www.hikingtrails.org/routes/north-ridge
https://travel.slowtrains.net/en/lisbon
https://reisen.bergundtal.de/wandern/12
https://voyages.petitport.fr/bretagne/
https://rutas.sierraalta.es/senderos/3
https://m.chessclub.org/openings/sicilian
https://forum.woodworkers.net/t/dovetail-joints
https://forum.astronomy-club.org/viewtopic?id=77
https://wiki.homebrewing.net/malt
https://www.birdwatchers.org/species/wren
https://physics.stackexchange.com/questions/1234
https://lists.debian.org/debian-devel/2019/
https://www.kernel.org/doc/html/latest/
https://sqlite.org/lang_select.html
https://www.postgresql.org/docs/current/indexes.html
https://numpy.org/doc/stable/user/basics.html
https://duckdb.org/docs/sql/introduction
https://www.openstreetmap.org/way/100
https://musescore.org/en/handbook
https://www.imslp.org/wiki/Cello_Suite
https://poetry.leafandstone.org/autumn/4
https://stories.lanternpress.net/chapter/two
https://www.rfc-editor.org/info/rfc3986
https://www.unicode.org/charts/
https://gcc.gnu.org/onlinedocs/
https://git-scm.com/book/en/v2
https://pandas.pydata.org/docs/user_guide/index.html
https://www.usgs.gov/faqs/earthquakes
https://www.parliament.uk/about/how/laws/
https://www.rijksmuseum.nl/en/collection
https://www.museodelprado.es/coleccion
https://www.bnf.fr/fr/gallica
https://www.dwd.de/DE/wetter/
https://www.britannica.com/science/photosynthesis
https://hal.science/documents/recent
https://school.hillcrest.org/timetable
https://parents.greenmeadow.net/newsletter/june
https://church.saintanne.org/services
https://choir.eastside.net/concerts/spring
https://clinic.lakeside.org/opening
https://hospital.westend.net/departments/cardiology
https://law.justice-review.org/cases/appeal
https://journal.soilscience.org/volume/12
https://proceedings.fieldstudies.net/paper/31
https://press.smallpublisher.org/catalogue
https://films.cinematheque.net/silent/1925
https://radio.communitywaves.org/schedule
https://ferry.islandline.net/timetable
https://trains.regional.org/lines/4
https://bakery.cornerstreet.net/bread
https://shop.bookbinders.org/paper
https://repair.bicycle-kitchen.org/wheels
https://maths.olympiad.net/problems/2003
https://history.tradesunion.org/strikes/1926
"""


def rows() -> list[tuple[str, int]]:
    """(url, 1 to block)."""
    return [(url, label) for text, label in ((BLOCK, 1), (ALLOW, 0)) for url in text.split()]
